"""The training-data operators against plain versions, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import (
    decontaminate,
    langid,
    licenses,
    mixing,
    pii,
    quality,
    setjoin,
    suffixes,
    tokencounts,
    winnow,
)
from ebbtide.llm.graph import components
from ebbtide.llm.vectors import sliding_min, window_hashes

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, start=0):
    """Documents with columns of names that operators use inside."""
    rows = [(start + i, t, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"{DOCS}, row string, size int")


def collected(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) if columns[1:] else r[columns[0]] for r in df.collect()}


# --- components ------------------------------------------------------------------


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (201, 200), (5, 5), (300, 300)]
    got = components(spark.createDataFrame(edges, "u long, v long"))
    found = {r.node: r.component for r in got.collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- quality ---------------------------------------------------------------------


def test_quality_learns_and_holds_out(spark):
    rng = random.Random(1)
    words = ["the", "of", "rain", "stone", "river", "and", "green"]
    good = [" ".join(rng.choice(words) for _ in range(30)) + "." for _ in range(120)]
    bad = [" ".join(rng.choice(words).upper() + "!!" for _ in range(30)) for _ in range(120)]
    docs = frame(spark, [t for pair in zip(good, bad, strict=True) for t in pair])
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (0, None), (9999, 0)], labels.schema))
    weights = quality.train(docs, labels)
    assert (quality.train(docs, labels) == weights).all()
    scores = collected(quality.score(docs, weights), "score")
    right = [(s >= 0.5) == (i % 2 == 0) for i, s in scores.items()]
    assert np.mean(right) > 0.98
    held = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held")).collect()
    assert 20 < sum(r.held for r in held) < 80


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, " \n "), (None, "a b")], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    weights = quality.train(docs, labels)
    assert [r.score for r in quality.score(docs, weights).collect()] == [0.5] * 4
    assert quality.score(docs.limit(0), weights).count() == 0
    assert quality.keep_good(docs.withColumn("score", F.lit(1)), weights, 0.5).count() == 4


# --- winnowing -------------------------------------------------------------------


def test_sliding_min():
    values = np.random.default_rng(3).integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 8, 49, 200):
        assert (sliding_min(values, width) == [values[i : i + width].min() for i in range(201 - width)]).all()


def test_winnow_chooses_rightmost_and_guarantees_matches():
    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(300))
    k, w = 4, 6
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    hashes = window_hashes(codes, k) >> np.uint64(32)
    expected = []
    for i in range(len(hashes) - w + 1):
        window = hashes[i : i + w]
        at = i + max(j for j in range(w) if window[j] == window.min())
        if not expected or expected[-1] != at:
            expected.append(at)
    found, positions = winnow.winnow(text, k, w)
    assert positions.tolist() == expected
    assert found.tolist() == hashes[expected].tolist()
    inner = text[100 : 100 + k + w - 1]
    other = "c" * 17 + inner + "d" * 23
    assert set(winnow.winnow(other, k, w)[0].tolist()) & set(found.tolist())


def test_followers(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcé😀 \n") for _ in range(rng.choice([0, 1, 2, 5, 90, 400]))) for _ in range(60)]
    ids = rng.sample(range(-500, 10_000), len(texts))
    docs = spark.createDataFrame([*zip(ids, texts, strict=True), (20_000, None)], DOCS)
    got = {r.doc_id: r for r in winnow.with_follower(docs).collect()}
    ordered = [(i, t or "") for i, t in sorted([*zip(ids, texts, strict=True), (20_000, None)])]
    assert len(got) == len(ordered)
    for (i, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        own, mark, following = (winnow.winnow(x) for x in (t, edited, n))
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (winnow.packed(*own), winnow.packed(*mark))
        assert r.near_edited == winnow.likeness(own[0], mark[0])
        assert r.near_next == winnow.likeness(own[0], following[0])


def test_followers_of_few_rows(spark):
    assert winnow.with_follower(spark.createDataFrame([], DOCS)).count() == 0
    one = winnow.with_follower(spark.createDataFrame([(3, "abcd")], DOCS)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    same = spark.createDataFrame([(None, "zz"), (None, "yy"), (1, "aaaa"), (1, "bbbb")], DOCS)
    got = winnow.with_follower(same).collect()
    following = {"aaaa": "aabb", "bbbb": "bbyy", "yy": "yz", "zz": "za"}
    assert sorted(r.edited_sha256 for r in got) == sorted(
        hashlib.sha256(t.encode()).hexdigest() for t in following.values()
    )
    prints = winnow.fingerprints(frame(spark, ["abc", None]))
    assert {len(r.hashes) for r in prints.collect()} == {1, 0}


# --- mixing ----------------------------------------------------------------------


def plain_targets(sizes):
    """Shares by weight, the excess over three times a size dealt again until none is left."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {**{s: 3.0 * sizes[s] for s in stopped}, **share}
        stopped |= above


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["b", "a", "c", "é", None, "tiny"] if i < 30 else ["a", "a", "b", None]), rng.randint(0, 90)) for i in range(400)]
    rows += [(7, "a", 50), (None, "b", 10), (401, "empty", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.mix_sources(docs).collect()
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    targets = plain_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_word_count(spark):
    got = collected(frame(spark, [None, "", " a\tb\x0bc ", "é x y"]).select("doc_id", mixing.word_count(F.col("text")).alias("n")), "n")
    assert list(got.values()) == [0, 0, 3, 2]


# --- language models -------------------------------------------------------------


def test_language_models(spark):
    rng = random.Random(6)
    stock = {"aa": ["ban", "tolu", "mir", "sa"], "bb": ["schr", "tzü", "kei", "ung"]}
    rows = []
    for i in range(200):
        lang = "aa" if i % 2 else "bb"
        rows.append((i, " ".join("".join(rng.choice(stock[lang]) for _ in range(3)) for _ in range(20)), lang))
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "12 .", "bb"), (902, "sa", None)], f"{DOCS}, lang string")
    model = langid.train(docs.where("doc_id % 4 != 0"))
    assert model.langs == ["aa", "bb"]
    got = {r.doc_id: r for r in langid.score(docs.drop("lang"), model).collect()}
    assert all(got[i].lang_pred == lang and 0.5 < got[i].score <= 1 for i, _, lang in rows)
    assert {got[900].lang_pred, got[901].lang_pred} == {"und"} and got[902].lang_pred == "aa"
    strange = langid.score(frame(spark, ["xqxqxq jvjvjv wpwpwp"]).select("doc_id", "text"), model).first()
    assert strange.rejected and not got[0].rejected
    # Probabilities after any context add up to one.
    for column, lang in enumerate(model.langs):
        units = sorted({c for _, t, x in rows if x == lang for c in f" {t} "})
        for context in ("  s", " sa", "ban", "xyz"):
            grams = np.array([[ord(c) for c in context + u] for u in units], dtype=np.int64)
            packed = (grams[:, 0] << 48) | (grams[:, 1] << 32) | (grams[:, 2] << 16) | grams[:, 3]
            total = np.exp(model.log_probabilities(packed).astype(float)).sum(axis=0)[column]
            assert 0.9 < total <= 1.0001


def test_language_without_models(spark):
    docs = spark.createDataFrame([(1, "abc", None)], f"{DOCS}, lang string")
    model = langid.train(docs)
    row = langid.score(docs, model).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)


# --- set join --------------------------------------------------------------------


def plain_groups(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in docs:
        w = WORD.findall((text or "").translate(lower))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_set_join(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(500)]
    docs = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 9, 12, 16, 18, 25, 40, 120, 400]))]
        docs.append(base)
        for _ in range(rng.randint(0, 8)):
            copy = list(docs[-1] if rng.random() < 0.5 else base)
            for _ in range(rng.choice([0, 1, 1, 2, len(copy) // 25])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)]
            docs.append(copy)
    passage = [f"p{i}" for i in range(60)]
    docs += [passage + [rng.choice(vocabulary) for _ in range(20 + i)] for i in range(30)]
    texts = [rng.choice([" ", "\n"]).join(d) for d in docs] + ["", None, " \t", "One two", "one  TWO"]
    rng.shuffle(texts)
    expected = plain_groups(list(enumerate(texts)))
    assert len({c for _, c in expected.values()}) < len(texts) - 20
    got = collected(setjoin.jaccard_groups(frame(spark, texts)), "n_shingles", "component_id")
    assert got == expected
    kept = setjoin.one_of_each_group(frame(spark, texts))
    assert {r.doc_id for r in kept.collect()} == {c for _, c in expected.values()}
    assert kept.columns == ["doc_id", "text", "row", "size"]


def test_set_join_edges(spark):
    assert setjoin.jaccard_groups(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, None), (6, "")]
    got = setjoin.jaccard_groups(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.n_shingles and r.doc_id) == [(4, 4), (4, 4)]
    assert [r.component_id for r in got if r.n_shingles == 0] in ([None, 6], [6, None])


def test_set_join_fetches_the_text_of_the_set(spark):
    words = [f"w{i}" for i in range(100)]
    chain = [" ".join([*(f"x{j}" for j in range(6 * i)), *words[6 * i :]]) for i in range(3)]
    others = " ".join(f"v{i}" for i in range(60))
    near = others.replace("v59", "u")
    # 1 and 3 are connected only through a row without id; 5 has two texts, each with a near copy.
    rows = [(1, chain[0]), (None, chain[1]), (3, chain[2]), (5, others), (5, words[0]), (7, near), (8, words[0].upper())]
    for ids in (rows, rows[::-1]):
        docs = spark.createDataFrame(ids, DOCS)
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in setjoin.jaccard_groups(docs).collect()}
        assert got == {
            (1, 96, 1), (None, 96, 1), (3, 96, 1), (5, 56, 5), (5, 1, 5), (7, 56, 5), (8, 1, 5)
        }
        assert sorted(r.doc_id or 0 for r in setjoin.one_of_each_group(docs).collect()) == [0, 1, 5, 5]


def test_linked_sets_share_a_signature():
    rng = random.Random(8)
    for n in [*range(1, 40), 55, 100, 180, 900]:
        for _ in range(30):
            a = {rng.getrandbits(64) for _ in range(n)}
            gone = rng.randint(0, n // 9)
            b = set(rng.sample(sorted(a), n - gone)) | {rng.getrandbits(64) for _ in range(gone)}
            if 100 * len(a & b) >= 80 * len(a | b):
                one, two = (setjoin.signatures(np.array(sorted(s), dtype=np.uint64)) for s in (a, b))
                both = set(one[0].tolist()) & set(two[0].tolist())
                for bit in {s % 2 for s in both}:
                    own = sum(s % 2 == bit for s in both)
                    assert own >= max(one[1][bit], two[1][bit]), (n, gone)
                assert both, (n, gone)


def test_sketch_distance_is_a_lower_bound(spark):
    rng = random.Random(12)
    rows = []
    for i in range(60):
        n = rng.randint(1, 300)
        a = {rng.getrandbits(64) for _ in range(n)}
        b = set(rng.sample(sorted(a), rng.randint(max(1, 2 * n // 3), n))) | {rng.getrandbits(64) for _ in range(rng.randint(0, n // 4))}
        one, two = (setjoin.parity_sketch(np.array(sorted(s), dtype=np.uint64)).tolist() for s in (a, b))
        if max(len(one), len(two)) <= 2 * min(len(one), len(two)):
            rows.append((len(a ^ b), one, two))
    df = spark.createDataFrame(rows, "differ int, a array<bigint>, b array<bigint>")
    got = df.select("differ", setjoin.hamming(F.col("a"), F.col("b")).alias("h")).collect()
    assert all(r.h <= r.differ and (r.differ - r.h) % 2 == 0 for r in got)
    assert sum(r.h for r in got) > 0.5 * sum(r.differ for r in got)


# --- token counts ----------------------------------------------------------------


def test_token_counts(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["rain", "xq", "über", "12"]) for _ in range(rng.randint(0, 200))) for _ in range(80)]
    texts += [None, "", "<|endoftext|>"]
    encode = tokencounts._encoder(tokencounts.VOCABULARY, tokencounts.WORDS).encode_ordinary
    lengths = [len(encode(t or "")) for t in texts]
    histogram = tokencounts.length_histogram(tokencounts.token_lengths(frame(spark, texts)))
    rows = {r.n_tokens: r for r in histogram.collect()}
    assert set(rows) == set(lengths)
    for limit, r in rows.items():
        above = [x for x in lengths if x > limit]
        assert (r.docs, r.tokens) == (lengths.count(limit), limit * lengths.count(limit))
        assert (r.docs_above, r.tokens_above) == (len(above), sum(above))
        assert r.truncated_tokens == sum(min(x, limit) for x in lengths)
        assert r.share_at_most == pytest.approx(1 - len(above) / len(lengths))
    limits = {r.context: r for r in tokencounts.at_limits(histogram, [10, 100]).collect()}
    assert limits[100].truncated_tokens == sum(min(x, 100) for x in lengths)
    assert limits[10].docs_above == sum(x > 10 for x in lengths)
    half = tokencounts.length_quantiles(histogram, [0.5]).first().n_tokens
    assert half == sorted(lengths)[(len(lengths) + 1) // 2 - 1]
    assert tokencounts.length_histogram(tokencounts.token_lengths(frame(spark, ["a"]).limit(0))).count() == 0


# --- decontamination -------------------------------------------------------------

QUESTION = "If Tom has 3 apples and Ann gave Tom 4 kg of flour how many apples does Tom have now in total"


def test_decontamination(spark):
    benchmark = spark.createDataFrame(
        [(1, QUESTION), (1, QUESTION), (2, "short item here"), (3, None), (4, "...")], "item_id long, text string"
    )
    texts = {
        1: "Solve. " + QUESTION.replace("Tom", "Bob").replace("Ann", "Eve").replace(" 3 ", " 7 ").replace("4 kg", "9 lbs"),
        2: "Solve. " + QUESTION.replace("gave Tom", "gave Max").replace("does Tom", "does Jim"),  # inconsistent
        3: "words before " + QUESTION.lower() + " and after",
        4: "a SHORT item, here it is",
        5: "if tom has other things to do today then nothing is left of it",
        6: None,
        7: "",
        None: "short item here",
    }
    docs = spark.createDataFrame(list(texts.items()), DOCS).withColumn("leaked", F.lit(1))
    found = decontaminate.contaminated(docs, benchmark)
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert pairs == {(1, 1), (3, 1), (4, 2), (None, 2)} or pairs == {(1, 1), (4, 2), (None, 2)}
    assert (1, 1) in pairs and (2, 1) not in pairs
    left = {r.doc_id for r in decontaminate.without_contaminated(docs, found).collect()}
    assert left == set(texts) - {i for i, _ in pairs}
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0


def leaks(spark, item, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    return {r.doc_id: r for r in decontaminate.contaminated(docs, benchmark).collect()}


def test_names_at_starts_and_other_letter_case_leak(spark):
    item = (
        "Tom has 3 apples and 2 pears. Tom gives 1 apple to his friend. Tom then buys 4 plums. "
        "How many fruits are left now?"
    )
    other = item.replace("Tom", "Lena").replace("3", "8").replace("2", "5").replace("4", "9")
    found = leaks(spark, item, [other, item.lower(), item.upper(), item.lower().replace("3", "7"), item.replace(". How", ", how").replace("3", "7")])
    assert set(found) == {0, 1, 2, 3, 4}
    assert (found[0].windows, found[0].item_windows) == (18, 18) and found[1].windows == 18
    assert set(leaks(spark, QUESTION, ["words before " + QUESTION.lower() + " and after"])) == {0}


def test_slots_are_read_window_by_window(spark):
    item = (
        "Tom has 3 apples and 2 pears. Tom gives 1 apple to his friend. Tom then buys 4 plums. "
        "How many fruits are left now?"
    )
    torn = item.replace("Tom", "Lena", 1).replace("Tom", "Max", 1).replace("Tom", "Eve", 1)
    asked = item.replace("Tom", "Lena").replace("3", "8").replace("2", "5").replace("4", "9")
    texts = [
        item.replace("Tom then", "Max then"),  # one instance edited
        item.replace("apple to", "apple back to"),  # a word inserted
        asked.replace("gives 1", "then gives 1"),
        asked + " " + asked.replace("Lena", "Bob"),  # twice, with other values
        torn,
    ]
    assert set(leaks(spark, item, texts)) == {0, 1, 2, 3}


def test_tokens_stay_aligned(spark):
    texts = ["The Tall man paid 3.50 dollars, then Bob's 12kg bag 1:30 x2 É", "", None, " a"]
    df = frame(spark, texts).select(
        decontaminate.canonical(F.col("text")).alias("a"), decontaminate.raw_tokens(F.col("text")).alias("b")
    )
    for r in df.collect():
        assert (r.a is None) == (r.b is None) and len(r.a or []) == len(r.b or [])


# --- personal data ---------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]:
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def test_base_spans(spark):
    rng = random.Random(10)
    parts = ["@", ".", "-", "+", "a", "9", "1", " ", "%", "_", "(", ")", "0", "2", "é", "😀", "\n", "4111111111111111", "1.2.3.4", "a@b.c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    texts += ["a@b.c_d@e.f.g", "+1 (275) 555-5927.", "1.2.3.4.5.6.7.8", "9" * 20000, "a" * 20000 + "@", "+1" + " " * 9000, None, ""]
    texts += ["é a@b.c " * 1700, "1 " * 200_000, "x" + "." * 50_000 + "1"]
    found = pii.find_personal_data(frame(spark, texts), "doc_id", "text").collect()
    for r in found:
        assert [tuple(s) for s in r.base] == plain_spans(r.text or "")
    assert sum(len(r.base) for r in found) > 300


def test_patterns_discover_identifiers(spark):
    seeds = [f"please contact me at user{i}@mail.example or call later" for i in range(8)]
    texts = [*seeds, "please contact me at user9@localhost or call later", "it cost 12345 in all", "nothing here"]
    docs = frame(spark, texts)
    got = collected(pii.find_personal_data(docs, "doc_id").select("doc_id", pii.spelled(F.col("spans")).alias("s")), "s")
    assert got[8] == f"found:{texts[8].index('user9')}:{texts[8].index(' or')}"
    assert got[9] == got[10] == "" and got[0].startswith("email:21:")
    masked = pii.find_personal_data(docs, "doc_id", "text").select("doc_id", pii.masked(F.col("text"), F.col("spans")).alias("m"))
    assert collected(masked, "m")[0] == "please contact me at [email] or call later"
    assert collected(masked, "m")[8] == "please contact me at [found] or call later"
    assert pii.find_personal_data(docs.limit(0), "doc_id").count() == 0


# --- suffixes --------------------------------------------------------------------


def plain_removal(texts, width):
    starts = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if starts[t[i : i + width]] > 1:
                gone[i : i + width] = b"\x01" * width
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("width", [16, 50, 200])
def test_repeats_are_removed(spark, width):
    rng = random.Random(width)
    stock = ["".join(rng.choice("abé \n") for _ in range(700)) for _ in range(5)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            at, size = rng.randrange(600), rng.randrange(3 * width)
            parts += [rng.choice(stock)[at : at + size], "".join(rng.choice("xyz") for _ in range(rng.randint(0, 5)))]
        texts.append("".join(parts))
    texts += ["", "a" * 500, "ab" * 200, texts[3], texts[3], stock[0]]
    got = suffixes.remove_repeats(frame(spark, texts), width)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()}
    assert list(map(found.get, range(len(texts)))) == plain_removal([t.encode() for t in texts], width)


def test_repeats_across_segments(spark, monkeypatch):
    rng = random.Random(11)
    text = bytes(rng.choice(b"abc") for _ in range(900))
    whole = np.concatenate(list(suffixes._stretches(np.frombuffer(text, np.uint8), 1, 40)))
    monkeypatch.setattr(suffixes, "_SEGMENT", 100)
    cut = np.concatenate(list(suffixes._stretches(np.frombuffer(text, np.uint8), 1, 40)))

    def runs(rows):
        return {int(w): int(r["pos"]) for r in rows for w in range(int(r["pos"]) - int(r["l"]), int(r["pos"]) - int(r["r"]) + 1)}

    assert runs(whole) == runs(cut) and len(runs(cut)) == 861


def test_repeats_edges(spark):
    rows = [(None, None), (None, ""), (1, "x" * 199), (2, "é" * 150), (2, "é" * 150)]
    got = sorted(tuple(r)[:3] for r in suffixes.remove_repeats(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(0, 0, 0), (0, 0, 0), (199, 0, 0), (300, 300, 1), (300, 300, 1)]
    assert suffixes.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_repeats(spark.createDataFrame([], DOCS), 8)


# --- licences --------------------------------------------------------------------


def test_licenses(spark):
    files = spark.createDataFrame(
        [
            (1, "a/LICENSE", "Released under the MIT License."),
            (2, "a/b/x.py", "foo bar"),
            (3, "a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0\n"),
            (4, "a/b/c/y.py", "nothing"),
            (5, "z.py", "code\nThis work is licensed under the GNU General Public License, version 3.\ncode"),
            (6, "q/w.py", None),
            (7, None, "x"),
            (8, "a/z.txt", ""),
            (9, "a/b/own.py", "Licensed under CC BY-NC 4.0."),
            (10, "q/talk.py", "your licence to drive has been revoked by the office"),
        ],
        "file_id long, path string, text string",
    )
    got = {r.file_id: (r.licence, r.origin) for r in licenses.scan_licenses(files).collect()}
    assert got == {
        1: ("MIT", "licence file"),
        2: ("Apache-2.0", "inherited"),
        3: ("Apache-2.0", "licence file"),
        4: ("Apache-2.0", "inherited"),
        5: ("GPL-3.0", "header"),
        6: (None, None),
        7: (None, None),
        8: ("MIT", "inherited"),
        9: ("CC-BY-NC-4.0", "header"),
        10: (None, None),
    }
    assert licenses.scan_licenses(files.limit(0)).count() == 0


MIT_TEXT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions.
"""


@pytest.mark.parametrize("small", [licenses._SMALL, -1])
def test_licences_in_real_files(spark, monkeypatch, small):
    """Whole licence texts, tags, notices inside prose and over line breaks, names of licence files, long texts."""
    monkeypatch.setattr(licenses, "_SMALL", small)
    prose = "we wrote this long tale of many words for all who like to read " * 3
    given = [
        ("a/LICENSE", MIT_TEXT, "MIT", "licence file"),
        ("a/x.txt", "x", "MIT", "inherited"),
        ("b/LICENSE-APACHE", "Licensed under the Apache License, Version 2.0", "Apache-2.0", "licence file"),
        ("b/c/d.txt", "d", "Apache-2.0", "inherited"),
        ("g/COPYING.LESSER", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n", "LGPL-3.0", "licence file"),
        ("g/d.txt", None, "LGPL-3.0", "inherited"),
        ("t/tag.py", "# SPDX-License-Identifier: MIT\ncode()", "MIT", "header"),
        ("t/later.py", "// SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0", "header"),
        ("t/prose.md", prose + "Released under the MIT License. " + prose, "MIT", "header"),
        ("t/wrapped.md", "Licensed under the\n  Apache License,\n  Version 2.0 by us", "Apache-2.0", "header"),
        ("t/none.md", prose + "ask for permission before you use the kitchen " + prose, None, None),
        ("t/license.py", "def check(license): return license", None, None),
        ("t/long.txt", "word " * 60_000 + "Released under the MIT License. " + "word " * 60_000, "MIT", "header"),
        ("t/tie.md", "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MPL-2.0", "MIT", "header"),
    ]
    files = spark.createDataFrame(
        [(i, p, t, "own", 1.0) for i, (p, t, _, _) in enumerate(given)],
        "file_id long, path string, text string, licence string, cosine double",
    )
    got = {r.path: (r.licence, r.origin) for r in licenses.scan_licenses(files).collect()}
    assert got == {p: (licence, origin) for p, _, licence, origin in given}


@pytest.mark.parametrize("small", [pii._SMALL, -1])
def test_seeds_with_spaces(spark, monkeypatch, small):
    """A phone number or card written with spaces is one seed, and finds what stands where it stands."""
    monkeypatch.setattr(pii, "_SMALL", small)
    texts = [f"please call the desk on +1 (555) 555-10{i:02} for help" for i in range(8)]
    texts += ["please call the desk on 0800-4455 for help", "the desk on 0800-9999 of the shop", "on 1234567 x", None, ""]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "row long, text string, base string")
    got = {r["row"]: pii_spelled for r in pii.find_personal_data(docs, "row").withColumn(
        "s", pii.spelled(F.col("spans"))).collect() for pii_spelled in [r["s"]]}
    assert got[0] == "phone:24:41"
    assert got[8] == "found:24:33"
    assert {got[i] for i in (10, 11, 12)} == {""}
