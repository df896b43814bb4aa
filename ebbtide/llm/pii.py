"""Personal data: base patterns, and identifiers found by the company they keep.

With built-in functions only. The base patterns find e-mail addresses, IP
addresses, payment cards and phone numbers. Their whole matches are seeds, with the
spaces they have: the words around them and their shape become lexical patterns, patterns and values form a
graph, and confidence goes back and forth along it: a pattern's is the mean of
its values', a value's that of any of its patterns being right. Values that reach
``CONFIDENT`` through patterns that enough seeds support are identifiers the base
patterns do not know; their spans are added as kind ``found``.

Patterns are read to equal results with the plain ones of ``KINDS``, but written
so that a long run of one character costs linear time: a match begins where a
run begins or where the last match ended.

Defined results: NULL is the empty text, which has no spans; repeated rows have
their own spans each and count once each as support; offsets are code points
with exclusive ends; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.sources.storage import stored

_LOCAL = "[A-Za-z0-9._%+-]"
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Kind, the pattern of its matches, and a quick necessary condition.
KINDS = (
    ("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
)
FOUND = "found"
#: A word with a digit or an at sign: what can be an identifier.
_CANDIDATE = r"(?:(?<![^\s])|\G)[^\s0-9@]*+[0-9@][^\s]*+"
_CONTEXT = 80
#: Matches of a text whose offsets are summed at a time.
_CHUNK = 500
ROUNDS, SUPPORT, CONFIDENT = 3, 3, 0.9
_PATTERN_CONFIDENCE = 0.75
#: Bytes up to which a checked table is sent to all executors.
_SMALL = 16 << 20


def _cumulated(lengths: Column) -> Column:
    """Running sums of an array<int>, each up to and with its element.

    Sums grow by copying, so they are made for chunks first and then shifted by
    what lies before each chunk: a text with very many matches stays cheap.
    """

    def running(values: Column) -> Column:
        begun = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            values,
            begun,
            lambda acc, x: F.struct(
                (acc["sum"] + x).alias("sum"),
                F.concat(acc["out"], F.array(acc["sum"] + x)).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    def shifted(chunks: Column, totals: Column) -> Column:
        before = F.zip_with(running(totals), totals, lambda upto, own: upto - own)
        return F.flatten(
            F.zip_with(chunks, before, lambda c, shift: F.transform(c, lambda x: x + shift))
        )

    def summed(values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(_CHUNK))
        chunks = F.transform(starts, lambda i: running(F.slice(values, i + 1, _CHUNK)))
        return _let(chunks, lambda c: _let(F.transform(c, _last), lambda t: shifted(c, t)))

    return _let(lengths, summed)


def _last(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(0))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value, before, after>> of a pattern's matches, left to right.

    The pieces between matches and the matches alternate, so their lengths add up to offsets.
    """

    def placed(pieces: Column, values: Column) -> Column:
        left, right = (F.slice(pieces, F.lit(i), F.size(values)) for i in (1, 2))
        lengths = F.zip_with(left, values, lambda p, v: F.char_length(p) + F.char_length(v))
        around = F.zip_with(
            left,
            right,
            lambda p, q: F.struct(
                F.right(p, F.lit(_CONTEXT)).alias("before"), F.left(q, F.lit(_CONTEXT)).alias("after")
            ),
        )
        spans = F.zip_with(
            _cumulated(lengths),
            values,
            lambda end, v: F.struct(
                (end - F.char_length(v)).alias("start"), end.alias("end"), v.alias("value")
            ),
        )
        return F.zip_with(
            spans,
            around,
            lambda m, w: F.struct(
                m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
                w["before"].alias("before"), w["after"].alias("after"),
            ),
        )

    parts = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"),
    )
    return _let(parts, lambda x: placed(x["pieces"], x["values"]))


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.char_length(digits) - i + 1, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(places, F.lit(0), step) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    count = F.char_length(digits)
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": F.when((count >= 14) & (count <= 19), _luhn(digits)).otherwise(False),
        "phone": (count >= 10) & (count <= 15),
    }[kind]


_SPAN = "struct<start:int,order:int,end:int,kind:string>"
_MATCH = "struct<start:int,order:int,end:int,kind:string,value:string,before:string,after:string>"


def _base_matches(text: Column) -> Column:
    """array<struct<start, order, end, kind, value, before, after>> of the base patterns, sorted."""
    found = []
    for order, (kind, pattern, quick) in enumerate(KINDS):
        spans = F.transform(
            F.filter(_matches(text, pattern), lambda m: _valid(kind, m["value"])),
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(order).alias("order"),
                m["end"].alias("end"), F.lit(kind).alias("kind"),
                m["value"].alias("value"), m["before"].alias("before"), m["after"].alias("after"),
            ),
        )
        none = F.array().cast(f"array<{_MATCH}>")
        found.append(F.when(text.rlike(quick), spans).otherwise(none))
    return F.array_sort(F.concat(*found))


def _spans_of(matches: Column) -> Column:
    return F.transform(
        matches, lambda m: F.struct(*(m[name].alias(name) for name in ("start", "order", "end", "kind")))
    )


def base_spans(text: Column) -> Column:
    """array<struct<start, order, end, kind>> of the base patterns, sorted."""
    return _spans_of(_base_matches(text))


def _company(value: Column, m: Column) -> tuple[Column, ...]:
    """left2, left, right, shape: the words around a value of a match, and what it looks like."""
    return (
        F.lower(F.regexp_extract(m["before"], r"(\S+)\s+\S+\s+$", 1)).alias("left2"),
        F.lower(F.regexp_extract(m["before"], r"(\S+)\s+$", 1)).alias("left"),
        F.lower(F.regexp_extract(m["after"], r"^\s*(\S+)", 1)).alias("right"),
        F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), r"\p{L}+", "a").alias("shape"),
    )


def _seeds(matches: Column) -> Column:
    """As _candidates, of base matches: each is one value, with the spaces it has."""
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), *_company(m["value"], m)
        ),
    )


def _candidates(text: Column) -> Column:
    """array<struct<start, end, value, left2, left, right, shape>> of possible identifiers."""
    edge = r"^[^A-Za-z0-9+]+"

    def item(m: Column) -> Column:
        tail = F.regexp_replace(m["value"], edge, "")
        value = F.regexp_replace(tail, r"(?<![^A-Za-z0-9])[^A-Za-z0-9]++$", "")
        start = m["start"] + F.char_length(m["value"]) - F.char_length(tail)
        return F.struct(
            start.alias("start"), (start + F.char_length(value)).alias("end"), value.alias("value"),
            *_company(value, m),
        )

    kind = (
        "struct<start:int,end:int,value:string,left2:string,left:string,right:string,shape:string>"
    )
    found = F.filter(F.transform(_matches(text, _CANDIDATE), item), lambda c: F.char_length(c["value"]) >= 5)
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(f"array<{kind}>"))


def _confident_values(seen: DataFrame) -> DataFrame:
    """Values that are no seeds but keep their company, from occurrences (c, seed)."""
    left, shape = F.col("c.left"), F.col("c.shape")
    patterns = F.array(
        F.struct(F.lit("words").alias("of"), F.col("c.left2").alias("a"), left.alias("b")),
        F.struct(F.lit("around").alias("of"), left.alias("a"), F.col("c.right").alias("b")),
        F.struct(F.lit("word").alias("of"), left.alias("a"), shape.alias("b")),
    )
    edges = stored(
        seen.where(left != "")
        .select(F.explode(patterns).alias("pattern"), F.col("c.value").alias("value"), "seed")
        .groupBy("pattern", "value")
        .agg(F.max("seed").alias("seed")),
        "pii-edges",
    )
    seeds = edges.groupBy("value").agg(F.max("seed").alias("seed"))
    scores = stored(seeds.select("value", "seed", F.col("seed").cast("double").alias("score")), "pii-scores")
    for _ in range(ROUNDS):
        confidence = (
            edges.drop("seed").join(scores, "value")
            .groupBy("pattern")
            .agg((F.sum("score") / (F.count("*") + 1)).alias("confidence"), F.count_if("seed").alias("support"))
            .where((F.col("support") >= SUPPORT) & (F.col("confidence") >= _PATTERN_CONFIDENCE))
        )
        right = (
            edges.drop("seed").join(confidence, "pattern")
            .groupBy("value")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("reached"))
        )
        scores = stored(
            scores.join(right, "value", "left").select(
                "value",
                "seed",
                F.when(F.col("seed"), 1.0).otherwise(F.coalesce("reached", F.lit(0.0))).alias("score"),
            ),
            "pii-scores",
        )
    return scores.where(~F.col("seed") & (F.col("score") >= CONFIDENT)).select("value")


def find_personal_data(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep, with ``base`` and ``spans``: sorted arrays of <start, order, end, kind>."""
    text = F.coalesce("text", F.lit(""))
    found = stored(
        # In a struct, so that no name among the columns to keep meets another.
        docs.select(F.struct(*keep).alias("kept"), _base_matches(text).alias("matches"), _candidates(text).alias("candidates"))
        .select("kept", _spans_of(F.col("matches")).alias("base"), _seeds(F.col("matches")).alias("seeds"), "candidates")
        .withColumn("row", F.monotonically_increasing_id()),
        "pii-found",
    )
    # Words of a base span are no values of their own: the whole span is.
    within = F.exists("base", lambda b: (b["start"] < F.col("c.end")) & (b["end"] > F.col("c.start")))
    others = found.select("row", "base", F.explode("candidates").alias("c")).where(~within)
    seen = others.select("row", "c", F.lit(False).alias("seed")).unionByName(
        found.select("row", F.explode("seeds").alias("c"), F.lit(True).alias("seed"))
    )
    values = _confident_values(seen)
    more = stored(
        seen.where(~F.col("seed"))
        .select("row", "c.start", "c.end", "c.value")
        .join(values, "value")
        .groupBy("row")
        .agg(
            F.collect_list(
                F.struct("start", F.lit(len(KINDS)).alias("order"), "end", F.lit(FOUND).alias("kind"))
            ).alias("more")
        ),
        "pii-more",
    )
    if more.agg(F.coalesce(F.sum(F.size("more") + 2), F.lit(0))).first()[0] * 40 <= _SMALL:
        more = F.broadcast(more)  # its size is checked; larger ones are joined by shuffle
    none = F.array().cast(f"array<{_SPAN}>")
    return (
        found.select("kept", "base", "row")
        .join(more, "row", "left")
        .select("kept.*", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))
    )


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        label = F.concat(gap, F.lit("["), s["kind"], F.lit("]"))
        inside = s["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["out"], F.when(inside, F.lit("")).otherwise(label)).alias("out"),
        )

    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = F.char_length(text)
    return F.aggregate(
        spans,
        begun,
        step,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, end - acc["at"])),
    )
