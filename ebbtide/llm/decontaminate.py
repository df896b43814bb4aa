"""Benchmark decontamination by template windows, with built-in functions only.

Texts become rows of tokens in three forms: numbers and units are placeholders in
all of them, names in none, in the middle of sentences, or wherever a token is
capitalised. So a question copied in another letter case, or asked again with
other values, keeps a form. Every window of ``WINDOW`` tokens of every document is
hashed in its forms and looked up among the windows of the benchmark; benchmark
texts with fewer tokens are one window of their own length.

A document holds an item if at least half of the item's windows count. A window
with the same words, letter case aside, counts as it is. The others count unless
they hold a value of the item that stands for several values of the document,
among the windows at the same shift and outside windows with the same words.

Defined results: NULL texts, and texts without letters and digits, have no
windows and match nothing; rows that share a document id count as one document,
repeated benchmark rows as one item; the matches of a NULL id have a NULL id;
extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.sources.storage import stored

WINDOW = 8
_FORMS = ("form0", "form1", "form2")
#: Share of an item's windows that a document must have.
COVERED = 0.5
#: Units of measure (fixed values), after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams lb lbs oz "
    "pound pounds ounce ounces ml l liter liters litre litres s sec second seconds min minute minutes "
    "h hr hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents"
).split()
_NAME, _NUMBER, _UNIT = "", "", ""
#: Stands before names within sentences.
_MARK = ""
_DIGITS = r"[0-9]+(?:[.,:/][0-9]+)*"
_LETTERS = r"[\p{L}\p{M}]+"
#: Bytes up to which a checked table is sent to all executors.
_SMALL = 16 << 20


def _with_units(text: Column) -> Column:
    """Numbers, and units after them, as placeholders."""
    text = F.regexp_replace(text, _DIGITS, _NUMBER)
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    # The placeholder comes first in the pattern, so most characters are passed at once.
    pattern = rf"({_NUMBER} ?){_MARK}?(?i:{units})(?![\p{{L}}\p{{M}}])"
    return F.regexp_replace(text, pattern, f"$1{_UNIT}")


def _marked(text: Column) -> Column:
    """Tokens, one space apart, with numbers and units as placeholders and names within sentences marked."""
    text = F.regexp_replace(text, f"[{_NAME}-{_MARK}]", " ")
    text = F.regexp_replace(
        text, r"\p{Lu}(?<=[\p{L}\p{M}0-9,;] .)\p{Ll}++(?![\p{L}\p{M}])", f"{_MARK}$0"
    )
    tokens = F.regexp_extract_all(text, F.lit(rf"{_DIGITS}|{_MARK}?{_LETTERS}"), F.lit(0))
    return _with_units(F.array_join(tokens, " "))


def _unmarked(marked: Column) -> Column:
    return F.replace(marked, F.lit(_MARK), F.lit(""))


def canonical(text: Column) -> Column:
    """Tokens with placeholders, form 1; token for token the same as ``raw_tokens``."""
    return _lowered(F.regexp_replace(_marked(text), f"{_MARK}[^ ]++", _NAME))


def raw_tokens(text: Column) -> Column:
    text = F.regexp_replace(text, f"[{_NAME}-{_UNIT}]", " ")
    return F.regexp_extract_all(text, F.lit(rf"{_DIGITS}|{_LETTERS}"), F.lit(0))


def _valued(raw: Column) -> Column:
    """Raw tokens, one space apart, with numbers and units as placeholders."""
    return _with_units(F.array_join(raw, " "))


def _lowered(spaced: Column) -> Column:
    return F.array_remove(F.split(F.lower(spaced), " "), "")  # a text without tokens has one, empty


def _named(spaced: Column) -> Column:
    """Every capitalised token is a name, wherever it stands."""
    return F.regexp_replace(
        spaced, r"\p{Lu}(?<![^ ].)(?=[\p{L}\p{M}]*?\p{Ll})[\p{L}\p{M}]++", _NAME
    )


def _forms(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep, and the tokens in each form, equally many.

    Form 0 leaves names as lower-case words, so equal words in any case are equal in it;
    1 takes names within sentences, 2 every capitalised token for a name.
    """
    # The regular expressions over the text run once for all forms.
    marked = docs.select(*keep, _marked(F.col("text")).alias("marked"))
    plain = marked.withColumn("plain", _unmarked(F.col("marked")))
    return plain.select(
        *keep,
        _lowered(F.col("plain")).alias("form0"),
        _lowered(F.regexp_replace("marked", f"{_MARK}[^ ]++", _NAME)).alias("form1"),
        _lowered(_named(F.col("plain"))).alias("form2"),
    )


def _windows(forms: DataFrame, size: int, *keep: str) -> DataFrame:
    """The columns to keep, h and at: the hashes, in every form, of each window of a size.

    Windows of 2, 4, 8 tokens come by doubling, from the tokens on, others from two that
    overlap. Each step is a projection of its own, so no array is made more than once.
    """

    def joined(rows: DataFrame, by: int, *more: Column) -> DataFrame:
        # Places without a full window hold anything, and are cut off at the end.
        return rows.withColumns(
            {
                f: F.zip_with(f, F.slice(f, by + 1, F.size(f)), lambda a, b: F.xxhash64(a, b, *more))
                for f in _FORMS
            }
        )

    width, rows = 1, forms.withColumn("n", F.greatest(F.size("form0") - size + 1, F.lit(0)))
    if size == 1:
        rows = rows.withColumns({f: F.transform(f, lambda t: F.xxhash64(t)) for f in _FORMS})
    while width * 2 <= size:
        rows, width = joined(rows, width), width * 2
    if width < size:
        rows = joined(rows, size - width, F.lit(size))
    # Exploded as an expression: Spark pushes a filter on a column's size down through all steps,
    # which would make the arrays again for each of them.
    hashes = F.concat(*(F.slice(f, 1, F.col("n")) for f in _FORMS))
    places = rows.select(*keep, "n", F.posexplode(hashes).alias("place", "h"))
    return places.select(*keep, (F.col("place") % F.col("n") + 1).alias("at"), "h")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, windows, item_windows, slots): the items that documents hold.

    Takes (doc_id, text) and (item_id, text).
    """
    raw = raw_tokens(F.col("text"))
    items = (
        benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
        .distinct()
        .select("item_id", "text", raw.alias("raw"), _lowered(_named(_valued(raw))).alias("tokens"))
        .where(F.size("tokens") > 0)
        .withColumn("size", F.least(F.size("tokens"), F.lit(window)))
    )
    items = stored(items, "leak-items")
    sizes = [r[0] for r in items.select("size").distinct().orderBy("size").collect()]  # window at most
    if not sizes:
        sizes = [window]
    forms = _forms(items, "item_id", "size")
    own = [
        _windows(
            forms.where(F.col("size") == size).withColumn("item_windows", F.size("form0") - size + 1),
            size,
            "item_id",
            "item_windows",
        )
        for size in sizes
    ]
    needles = stored(
        reduce(DataFrame.unionByName, own)
        .withColumnRenamed("at", "item_at")
        .distinct(),
        "leak-needles",
    )
    small = needles.count() * 40 <= _SMALL
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    forms = _forms(keyed, "doc_id", "key")
    # Items shorter than a window, of each length, take a pass of their own.
    hits = (
        reduce(DataFrame.unionByName, (_windows(forms, size, "doc_id", "key") for size in sizes))
        .join(F.broadcast(needles) if small else needles, "h")  # larger ones are joined by shuffle
        .select("doc_id", "key", "item_id", "item_windows", "item_at", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    hits = stored(hits, "leak-hits")
    enough = F.col("windows") >= COVERED * F.col("item_windows")
    held = stored(_counted(hits).where(enough), "leak-held")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["item_id"].eqNullSafe(b["item_id"])
    # The windows of a text that meet an item at the same shift.
    aligned = stored(
        hits.join(held, same(hits, held), "left_semi")
        .groupBy("doc_id", "key", "item_id", "item_windows", "shift")
        .agg(F.collect_list("item_at").alias("ats")),
        "leak-aligned",
    )
    sound = stored(_sound(keyed, items, aligned), "leak-sound")
    counted = _counted(sound.select("doc_id", "item_id", "item_windows", F.explode("ats").alias("item_at")))
    slots = (
        sound.select("doc_id", "item_id", F.explode("slots").alias("slot"))
        .distinct()
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("slots"))
    )
    return counted.where(enough).join(slots, same(counted, slots), "left").select(
        counted["doc_id"], counted["item_id"], "windows", "item_windows",
        F.coalesce("slots", F.lit(0)).cast("long").alias("slots"),
    )


def _counted(hits: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_windows, windows): how many windows of each item a document has."""
    one = hits.groupBy("doc_id", "item_id", "item_windows", "item_at").agg(F.lit(1).alias("one"))
    return one.groupBy("doc_id", "item_id", "item_windows").agg(F.count("one").alias("windows"))


def _sound(keyed: DataFrame, items: DataFrame, aligned: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_windows, ats, slots): the windows that count, shift by shift.

    Windows with the same words count as they are. In the others, a value of the item that
    stands for several values of the document, beside places that same words cover, does not.
    """
    ids = aligned.select(F.col("doc_id").alias("doc"), F.col("key").alias("own")).distinct()
    ids = stored(ids, "leak-texts")
    if ids.count() * 32 <= _SMALL:
        ids = F.broadcast(ids)
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("own"))
    texts = stored(
        keyed.join(ids, same, "left_semi")
        .dropDuplicates(["doc_id", "key"])
        .select(F.col("doc_id").alias("doc"), F.col("key").alias("own"), raw_tokens(F.col("text")).alias("doc_raw")),
        "leak-tokens",
    )
    given = items.select(F.col("item_id").alias("item"), "tokens", F.col("raw").alias("item_raw"), "size")
    given = F.broadcast(given) if given.count() * 1000 <= _SMALL else given
    lower = lambda words: F.transform(words, lambda t: F.lower(t))
    begin = F.greatest(F.col("shift"), F.lit(0))
    # The document's words beside the item's; none where the item reaches over the text's start.
    beside = F.concat(
        F.array_repeat(F.lit(None).cast("string"), F.greatest(-F.col("shift"), F.lit(0))),
        F.slice("doc_raw", begin + 1, F.size("tokens")),
    )
    rows = (
        aligned.join(texts, same)
        .join(given, F.col("item_id").eqNullSafe(F.col("item")))
        .select(
            "doc_id", "item_id", "item_windows", "ats", "tokens", "size",
            lower(F.col("item_raw")).alias("words"), lower(beside).alias("beside"),
        )
    )
    places = lambda at: F.sequence(at, at + F.col("size") - 1)
    word = lambda i: F.element_at("words", i)
    other = lambda i: F.try_element_at("beside", i)
    kind = lambda i: F.element_at("tokens", i)
    is_slot = lambda i: kind(i).rlike(f"[{_NAME}-{_UNIT}]")
    covered = lambda ats: F.array_distinct(F.flatten(F.transform(ats, places)))
    pair = lambda i: F.struct(kind(i).alias("kind"), word(i).alias("value"))
    literal = F.filter("ats", lambda at: F.forall(places(at), lambda i: word(i).eqNullSafe(other(i))))
    rows = rows.withColumn("literal", literal)
    rows = rows.withColumn("told", F.array_except("ats", "literal"))
    open_places = F.array_except(covered(F.col("told")), covered(F.col("literal")))
    rows = rows.withColumn("open", F.filter(open_places, is_slot))
    meanings = F.array_distinct(
        F.transform("open", lambda i: F.struct(pair(i).alias("of"), other(i).alias("to")))
    )
    rows = rows.withColumn("of", F.transform(meanings, lambda m: m["of"]))
    # Values that stand for several.
    rows = rows.withColumn(
        "torn",
        F.filter(F.array_distinct("of"), lambda v: F.size(F.filter("of", lambda w: w == v)) > 1),
    )
    rows = rows.withColumn("bad", F.filter("open", lambda i: F.array_contains("torn", pair(i))))
    kept = F.filter("told", lambda at: ~F.exists("bad", lambda i: (i >= at) & (i < at + F.col("size"))))
    rows = rows.withColumn("ats", F.concat("literal", kept))
    slots = F.transform(F.filter(covered(F.col("ats")), is_slot), pair)
    return rows.select("doc_id", "item_id", "item_windows", "ats", F.array_distinct(slots).alias("slots"))


def without_contaminated(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no item."""
    ids = stored(found.select(F.col("doc_id").alias("leaked")).distinct(), "leak-ids")
    same = docs["doc_id"].eqNullSafe(ids["leaked"])
    return docs.join(F.broadcast(ids) if ids.count() * 16 <= _SMALL else ids, same, "left_anti")
