"""N-gram Jaccard join by parity sketches.

A document is the set of hashes of its word shingles. A set's sketch XORs the
hashes that fall into each of ``K`` equal ranges of hash values (blocks): each
element toggles the bits of one block, so sketches of two sets differ in at most
as many blocks as the sets differ in elements. A link allows at most
(a + b) / 9 differing elements for sizes a and b; ``K`` is above that for all
sizes of a band, so linked sets agree in some blocks (pigeonhole), and blocks are
joined by content. Sets of up to 13 elements, with at most two elements beside
the common ones, are joined by the XOR of what is left without any two. All
candidate pairs are verified on the whole sets.

As ``K`` is half as large again as it must be, linked sets agree in a third of
their blocks. So a set that has fewer blocks in common with any others has no
link, and of the others each leaves out as many of its most frequent blocks as
it could miss: a passage that very many documents share makes few candidates.
Pairs are then held against whole parity sketches of two to four bits an element,
whose Hamming distance is at most the number of differing elements.

An empty block says nothing and is not joined; ``K`` is large enough that common
elements all fall into differing blocks with a chance below 1e-12, like that of
equal 64-bit hashes of different shingles.

Equal sets are one node. In a bucket of equal blocks each member is first
verified against one of them, in three rounds with others drawn at random; only
members that are then in different components meet each other. So a large group of near copies costs about as many
pairs as it has members, and no link between components is lost.

Defined results: NULL, empty and wordless texts have no shingles and stay by
themselves; fewer words than a shingle are one shingle; repeated rows are copies
of each other; a NULL id is never a component's id unless the component has no
other; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.graph import components
from ebbtide.llm.vectors import mix, prefix_hash, slices, span_hashes, words
from ebbtide.sources.storage import stored

WORDS, PERCENT = 5, 80
#: Sets below this size are joined by deletions.
_TINY = 14
_BAND = 1.8
#: Characters that are hashed at once, and signatures that a task holds before they travel.
_CHARS, _HELD = 1 << 18, 1 << 17
#: Bytes of block rows that one task gathers, and members verified with one copy of a centre.
_PART_BYTES, _SALT = 32 << 20, 64
#: Rounds in which a bucket's members meet one of them.
_STAR_ROUNDS = 3
#: Bytes up to which a checked table is sent to all executors.
_SMALL = 16 << 20


def shingle_sets(texts: list[str | None], n: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    for _, part in slices(texts, _CHARS):
        data, starts, ends, first = words(part, lower=True)
        if not len(starts):
            yield from (np.zeros(0, np.uint64) for _ in part)
            continue
        word = span_hashes(prefix_hash(data), starts, ends)
        size = max(len(word) - n + 1, 0)
        grams = word[:size]
        for k in range(1, n):
            grams = mix(grams) + word[k : size + k]
        grams = mix(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                short = np.array([b - a], dtype=np.uint64)
                for i in range(a, b):
                    short = mix(short) + word[i : i + 1]
                yield mix(short)
            else:
                yield np.zeros(0, np.uint64)


def set_key(hashes: np.ndarray) -> int:
    """A 64-bit key of a set."""
    total = np.add.reduce(mix(hashes)) + np.uint64(len(hashes))
    return int(mix(np.array([total]))[0].astype(np.int64))


def _bands() -> list[tuple[int, int]]:
    """(smallest size, blocks) of each band of sizes, beginning with ``_TINY``."""
    out, low = [], _TINY
    while low < 1 << 40:
        high = math.ceil(low * _BAND)
        most = 2 * (high - 1) // 9
        out.append((low, math.ceil(most * max(1.5, 10 ** (3 / most)))))
        low = high
    return out


_BANDS = _bands()
_LOWS = [low for low, _ in _BANDS]


def _blocks(hashes: np.ndarray, band: int) -> np.ndarray:
    blocks = _BANDS[band][1]
    at = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    content = np.bitwise_xor.reduceat(hashes, first)
    return mix(content + mix(at[first] + np.uint64(band + 1) * np.uint64(1 << 40)))


def signatures(hashes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """What linked sets have in common, and how many of these at least.

    A signature's last bit is that of its band's number: a set is in one or two
    neighbouring bands. The second result is by that bit; 1 where all must be kept.
    """
    n, out, least = len(hashes), [], [1, 1]
    band = int(np.searchsorted(_LOWS, n, side="right")) - 1
    bands = [band] + [band + 1] * (5 * n >= 4 * _LOWS[band + 1])
    for b in bands:
        if b < 0:
            whole = np.bitwise_xor.reduce(hashes)
            left = [
                np.bitwise_xor.reduce([whole, *some])
                for size in range(n // 5 + 1)
                for some in combinations(hashes, size)
            ]
            found = mix(np.array(left, dtype=np.uint64))
        else:
            found = _blocks(hashes, b)
            largest = min(5 * n // 4, _LOWS[b + 1] - 1)
            least[b % 2] = max(1, len(found) - (n + largest) // 9)
        out.append((found & ~np.uint64(1)) | np.uint64(b % 2))
    return np.concatenate(out), least


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """Bits, as 64-bit words, each the parity of the elements that hash to it."""
    bits = 64 << max(0, (2 * len(hashes) - 1).bit_length() - 6)
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def hamming(a: Column, b: Column) -> Column:
    """Distance of two sketches; a longer one is folded, which keeps parities."""

    def folded(x: Column, other: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        halves = F.slice(x, F.lit(1), half), F.slice(x, half + 1, half)
        once = F.zip_with(*halves, lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > F.size(other), once).otherwise(x)

    counts = F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(counts, F.lit(0), lambda total, x: total + x)


def _near(n: Column, n2: Column, sketch: Column, sketch2: Column) -> Column:
    """Whether sizes and sketches allow a link; no link fails this."""
    sizes = 100 * F.least(n, n2) >= PERCENT * F.greatest(n, n2)
    return sizes & (9 * hamming(sketch, sketch2) <= n + n2)


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, k, least0, least1, sketch): each document's set in short."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [
                (len(s), set_key(s), *(signatures(s)[1] if len(s) else (1, 1)), parity_sketch(s))
                for s in shingle_sets(batch["text"].tolist())
            ]
            rows = pd.DataFrame(sets, columns=names[1:])
            yield rows.assign(doc_id=batch["doc_id"].to_numpy(), text_key=batch["text_key"].to_numpy())[columns]

    names = ["doc_id", "n_shingles", "k", "least0", "least1", "sketch"]
    columns = ["doc_id", "text_key", *names[1:]]
    numbers = ", ".join(f"{c} long" for c in columns[1:6])
    keyed = docs.withColumn("text_key", F.coalesce(F.xxhash64("text"), F.lit(0)))
    return keyed.mapInPandas(found, f"doc_id {kind}, {numbers}, sketch array<bigint>")


def _cut(sigs: list[np.ndarray], keys: list[int], parts: int) -> pd.DataFrame:
    repeated = np.repeat(np.array(keys, dtype=np.int64), [len(x) for x in sigs])
    pairs = np.stack([np.concatenate(sigs).view(np.int64), repeated], axis=1)
    part = (pairs[:, 0].view(np.uint64) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    pairs, limits = pairs[order], np.searchsorted(part[order], np.arange(parts + 1))
    data = [pairs[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:], strict=True)]
    rows = pd.DataFrame({"part": range(parts), "data": data})
    return rows[rows["data"].str.len() > 0]


def _packed(batches: Iterator[pd.DataFrame], parts: int) -> Iterator[pd.DataFrame]:
    """(part, data): signatures of the batches' sets, each with its set's key."""
    seen: set[int] = set()
    for batch in batches:
        sigs, keys, held = [], [], 0
        for s in shingle_sets(batch["text"].tolist()):
            if len(s) and (key := set_key(s)) not in seen:
                seen.add(key)
                sigs.append(signatures(s)[0])
                keys.append(key)
                held += len(sigs[-1])
                if held >= _HELD:
                    yield _cut(sigs, keys, parts)
                    sigs, keys, held = [], [], 0
        if sigs:
            yield _cut(sigs, keys, parts)


def _shared(docs: DataFrame, parts: int) -> DataFrame:
    """(sig, k, sets): the sets of each signature that several sets have, and how many.

    Signatures travel as packed arrays, one for each part and some ``_HELD`` signatures.
    """

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _packed(batches, parts)

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        pairs = np.frombuffer(b"".join(group["data"]), dtype=np.int64).reshape(-1, 2)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        sig, k = pairs[:, 0], pairs[:, 1]
        new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (k[1:] != k[:-1])))
        sig, k = sig[new], k[new]
        first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        count = np.diff(np.append(first, len(sig)))
        several, sets = np.repeat(count > 1, count), np.repeat(count, count)
        return pd.DataFrame({"sig": sig[several], "k": k[several], "sets": sets[several]})

    blobs = docs.select("text").mapInPandas(packed, "part int, data binary")
    return blobs.groupBy("part").applyInPandas(joined, "sig long, k long, sets long")


def _candidates(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(sig, k): the signatures that can show a link."""
    bit = F.col("sig").bitwiseAND(F.lit(1))
    least = F.when(bit == 0, F.col("least0")).otherwise(F.col("least1"))
    own = Window.partitionBy("k", "bit")
    rarest = own.orderBy("sets", "sig")
    kept = (
        shared.join(classes.select("k", "least0", "least1"), "k")
        .select("sig", "k", "sets", bit.alias("bit"), least.alias("least"))
        .withColumn("have", F.count("*").over(own))
        .withColumn("place", F.row_number().over(rarest))
        .where("place <= have - least + 1")
        .select("sig", "k")
    )
    kept = stored(kept, "set-join-kept")
    several = kept.groupBy("sig").agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a < b")
    return kept.join(several.select("sig"), "sig")


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (member, center), those (u, v) whose whole sets are similar enough.

    The members of a centre are dealt out in groups, each with its own copy of the centre.
    A set's text is fetched by id and key of the text: an id may be NULL or have several texts.
    """
    groups = pairs.groupBy("center").agg(F.ceil(F.count("*") / _SALT).alias("groups"))
    members = pairs.join(groups, "center").select(
        F.col("member").alias("k"),
        "center",
        F.pmod(F.xxhash64("member"), F.col("groups")).alias("salt"),
        F.lit(1).alias("turn"),
    )
    centers = groups.select(
        F.col("center").alias("k"),
        "center",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("salt"),
        F.lit(0).alias("turn"),
    )
    wanted = stored(
        members.unionByName(centers).join(
            classes.select("k", F.col("doc_id").alias("holder"), "text_key"), "k"
        ),
        "set-join-wanted",
    )
    if wanted.count() * 56 <= _SMALL:
        wanted = F.broadcast(wanted)  # its size is checked; larger ones are joined by shuffle
    sets = (
        docs.join(
            wanted,
            docs["doc_id"].eqNullSafe(F.col("holder")) & (F.xxhash64("text") == F.col("text_key")),
        )
        .repartition("center", "salt")
        .sortWithinPartitions("center", "salt", "turn")
        .select("center", "turn", "k", "text")
    )

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        center = held = None
        for batch in batches:
            edges = []
            texts = shingle_sets(batch["text"].tolist())
            rows = zip(batch["center"], batch["turn"], batch["k"], texts, strict=True)
            for own, turn, k, hashes in rows:
                if turn == 0:
                    center, held = own, hashes
                elif own == center:
                    both = len(np.intersect1d(held, hashes, assume_unique=True))
                    if 100 * both >= percent * (len(held) + len(hashes) - both):
                        edges.append((k, own))
            yield pd.DataFrame(edges, columns=["u", "v"], dtype="int64")

    return sets.mapInPandas(verified, "u long, v long")


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    sets = stored(_sets(docs), "set-join-sets")
    classes = stored(
        sets.where("n_shingles > 0")
        .groupBy("k")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.coalesce(F.min_by("text_key", "doc_id"), F.min("text_key")).alias("text_key"),
            F.first("n_shingles").alias("n"),
            *(F.first(c).alias(c) for c in ("least0", "least1", "sketch")),
        ),
        "set-join-classes",
    )
    total = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    deals = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = stored(_shared(docs, max(deals, total * 11 // _PART_BYTES)), "set-join-shared")
    shared = stored(_candidates(shared, classes), "set-join-candidates")

    marks = classes.select("k", "n", "sketch")
    other = marks.select(*(F.col(c).alias(f"{c}2") for c in marks.columns))
    near = _near(*(F.col(c) for c in ("n", "n2", "sketch", "sketch2")))

    def still_apart(found: DataFrame | None) -> DataFrame:
        """(sig, k, c) of the buckets that hold several components."""
        rows = shared.select("sig", "k", F.col("k").alias("c"))
        if found is not None:
            known = found.select(F.col("node").alias("k"), "component")
            rows = shared.join(known, "k", "left").select(
                "sig", "k", F.coalesce("component", "k").alias("c")
            )
        apart = rows.groupBy("sig").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a < b")
        return stored(rows.join(apart.select("sig"), "sig"), "set-join-open")

    # Members of a bucket meet one of them, drawn anew in each round.
    edges = found = tried = None
    for turn in range(_STAR_ROUNDS):
        rows = still_apart(found)
        leaders = rows.groupBy("sig").agg(
            F.min_by(F.struct("k", "c"), F.xxhash64("k", F.lit(turn))).alias("lead")
        )
        stars = (
            rows.join(leaders, "sig")
            .where("c != lead.c")
            .select("k", F.col("lead.k").alias("k2"))
            .distinct()
            .join(marks, "k")
            .join(other, "k2")
            .where(near)
            .select(F.col("k").alias("member"), F.col("k2").alias("center"))
        )
        stars = stored(stars, "set-join-stars")
        more = stored(_linked(docs, classes, stars, PERCENT), "set-join-edges")
        edges = more if edges is None else edges.unionByName(more)
        tried = stars if tried is None else tried.unionByName(stars)
        found = components(edges)

    # Those that are still apart meet each other.
    open_rows = stored(still_apart(found).join(marks, "k"), "set-join-open")
    others = open_rows.select(*(F.col(x).alias(f"{x}2") for x in ("sig", "k", "c", "n", "sketch")))
    apart_pair = (F.col("sig") == F.col("sig2")) & F.expr("k > k2 AND c != c2")
    known = tried.select(
        F.greatest("member", "center").alias("member"), F.least("member", "center").alias("center")
    ).distinct()
    pairs = (
        open_rows.join(others, apart_pair & near)
        .select(F.col("k").alias("member"), F.col("k2").alias("center"))
        .distinct()
        .join(known, ["member", "center"], "left_anti")
    )
    more = _linked(docs, classes, stored(pairs, "set-join-pairs"), PERCENT)
    found = components(edges.unionByName(more))

    grouped = classes.join(found.withColumnRenamed("node", "k"), "k", "left").select(
        "k", "doc_id", F.coalesce("component", "k").alias("c")
    )
    smallest = grouped.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    ids = grouped.join(smallest, "c").select("k", "component_id")
    joined = sets.where("n_shingles > 0").join(ids, "k")
    alone = sets.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ("doc_id", "n_shingles", "component_id")
    return joined.select(*columns).unionByName(alone.select(*columns))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose id is their component's.

    Rows that share an id stay or go together; rows with a NULL id stay.
    """
    groups = jaccard_groups(docs)
    gone = stored(
        groups.where("doc_id != component_id").select(F.col("doc_id").alias("gone")).distinct(),
        "set-join-gone",
    )
    same = docs["doc_id"] == gone["gone"]
    return docs.join(F.broadcast(gone) if gone.count() * 16 <= _SMALL else gone, same, "left_anti")
