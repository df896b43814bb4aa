"""Removal of repeated word windows against a plain version, and its edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest

from ebbtide.llm import sketchdedup
from ebbtide.llm.queries import QUERIES

DOCS = "doc_id long, text string, chunk string, part int, kept string, bits long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents with extra columns of names that the operator uses inside."""
    return spark.createDataFrame([(i, t, "c", 1, "k", 2) for i, t in rows], DOCS)


def plain(rows, width):
    """[(doc_id, n_words, n_removed, kept)] by the rule itself."""
    least = {}
    split = [(float("inf") if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for i, ws in split:
        for a in range(len(ws) - width + 1):
            key = tuple(ws[a : a + width])
            least[key] = min(i, least.get(key, i))
    out = []
    for (doc_id, _), (i, ws) in zip(rows, split, strict=True):
        gone = set()
        for a in range(len(ws) - width + 1):
            if least[tuple(ws[a : a + width])] < i:
                gone.update(range(a, a + width))
        out.append((doc_id, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["é", "stone", "Stone", " ", "a", "river,", "x" * 30, "\x1c", "日本"]
    passage = " ".join(rng.choice(vocabulary) + str(i) for i in range(20))
    texts = []
    for _ in range(150):
        own = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 4, 5, 30, 90]))]
        if rng.random() < 0.4:
            own.insert(rng.randrange(len(own) + 1), passage)
        texts.append(rng.choice([" ", "\n", "\t \r\n"]).join(own))
    texts += [texts[3]] * 30 + [None, "", " \n", passage, passage[1:], "word " * 2000]
    rows = list(zip(rng.sample(range(-500, 5000), len(texts)), texts, strict=True))
    rows += [rows[7], rows[8], (None, texts[3]), (None, passage), (None, "of its own " * 9), (9000, None)]
    rng.shuffle(rows)
    return rows


def held(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "width", "chunk"), [(1, 5, 64), (2, 4, 500), (3, 13, 8 << 20), (4, 1, 300)])
def test_equals_plain_version(spark, monkeypatch, seed, width, chunk):
    monkeypatch.setattr(sketchdedup, "_CHUNK", chunk)
    monkeypatch.setattr(sketchdedup, "_CHUNK_ROOT", 1)
    rows = made(seed)
    assert held(sketchdedup.remove_repeated_windows(frame(spark, rows), width)) == plain(rows, width)


def test_edges(spark):
    assert held(sketchdedup.remove_repeated_windows(frame(spark, []))) == []
    rows = [(1, None), (2, ""), (None, None)]
    assert held(sketchdedup.remove_repeated_windows(frame(spark, rows))) == plain(rows, 13)
    rng = random.Random(5)
    long = " ".join(str(rng.randrange(5000)) for _ in range(120_000))
    rows = [(5, long), (4, long[50_000:400_000]), (6, "before " + long)]
    assert held(sketchdedup.remove_repeated_windows(frame(spark, rows))) == plain(rows, 13)


def test_packed_arrays_return():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 32, 500).astype(np.uint64))
    assert (sketchdedup._unpacked(sketchdedup._packed(values, "<u4"), "<u4") == values).all()
    ids = np.sort(np.array([-(1 << 63), -5, 0, 7, (1 << 63) - 1]))
    assert (sketchdedup._unpacked(sketchdedup._packed(ids.view(np.uint64), "<u8"), "<u8").view(np.int64) == ids).all()


def test_prefilter_lets_few_unique_windows_pass(spark):
    """All windows of two documents pass; of unique ones, at most one in ten."""
    rng = random.Random(6)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(400)) for _ in range(50)]
    plan = sketchdedup._Plan(sum(map(len, texts)), 8, 13)
    messages = plan.sketch((np_scalar(0),), table(texts[:30]))
    other = plan.sketch((np_scalar(1),), table(texts[29:]))
    replies = merged(plan, [messages, other])
    sent = plan.repeated((np_scalar(0),), table(texts[:30]), replies[0])
    passed = sum(len(e) // 8 for e in sent.column("entries").to_pylist())
    assert 388 <= passed < 388 + 0.1 * 29 * 388


def np_scalar(value):
    import pyarrow as pa

    return pa.scalar(value)


def table(texts):
    import pyarrow as pa

    return pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})


def merged(plan, messages):
    """{chunk: replies} of some sketches."""
    import pyarrow as pa
    import pyarrow.compute as pc

    every, out = pa.concat_tables(messages), []
    for kind, part in {(k.as_py(), p.as_py()) for k, p in zip(every["kind"], every["part"], strict=True)}:
        group = every.filter(pc.and_(pc.equal(every["kind"], kind), pc.equal(every["part"], part)))
        out.append(plan.merge(group))
    replies = pa.concat_tables(out)
    return {c: replies.filter(pc.equal(replies["chunk"], c)) for c in (0, 1)}


def test_query_equals_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_substring_dedup"](spark, folder).collect()
    expected = [(i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in plain(rows, 13)]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(expected, key=str)
