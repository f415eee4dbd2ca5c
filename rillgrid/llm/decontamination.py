"""Benchmark decontamination by template windows.

Texts are canonicalised to tokens: letters and digits in lower case, while numbers, units after a number and names become
typed slots that keep their value aside. Windows of ``width`` tokens of which ``literals`` at least are no slots are hashed with
the slots' types only, and the documents' windows meet the benchmark's in a hash join. An item is found in a document if
``share`` of the item's distinct windows are there and its slots are consistent: each value of the item stands for one
value in the document (the most frequent one, over all matched windows, in ``agreement`` of them). So a question with other
numbers or names is found, and text that only shares its frame is not.

A document may hold an item several times with different values. A pair whose windows are there but do not agree over the
whole document is therefore looked at occurrence by occurrence: on each diagonal (document place less item place) by itself,
and with each item window taken from the match nearest to that diagonal, at most an item's length off, so that words put in
or left out do not part an occurrence. The item is found if one occurrence has ``share`` of the windows and agrees; n_windows
and slot_agreement are then that occurrence's (the best agreement, then the most windows).

An item of which no window has that many literals ("what is 12 km 7 m 3 kg 4 h") is found by its values themselves: all its
windows, hashed with what stands in the slots, and the same ``share`` of them; a copy with other values is not found.

Everything is DataFrame functions. Null and empty texts have no tokens and are never found; items with fewer than ``width``
tokens have no windows and are found nowhere. Repeated documents' rows of one id count as one document; repeated items as
one. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillgrid.llm.common import cut, held

#: Units that make a slot of their own after a number.
UNITS = ("mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks", "months", "years", "percent", "dollars", "euros", "usd", "eur", "meters", "metres", "miles", "feet", "inches", "pounds", "grams", "liters", "litres")
SPACE = r"[\s]+"
FEW_WINDOWS = 2_000_000  # benchmark windows that may be broadcast: about 100 MB at most


def tokens(texts: DataFrame) -> DataFrame:
    """texts with toks: words as lower-case letters and digits, slots as a type sign (# number, & unit, @ name) and their value."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda w: w.rlike(r"[\p{L}\p{N}]"))

    def one(w: Column, before: Column) -> Column:
        bare = F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}]+", ""))
        number = w.rlike(r"^[^\p{L}\p{N}]*[0-9]")
        unit = bare.isin(*UNITS) & F.coalesce(before.rlike(r"^[^\p{L}\p{N}]*[0-9]"), F.lit(False))
        name = w.rlike(r"^[^\p{L}\p{N}]*\p{Lu}\p{Ll}") & F.coalesce(~before.rlike(r"[.!?:][^\p{L}\p{N}]*$"), F.lit(False))
        return F.when(number, F.concat(F.lit("#"), bare)).when(unit, F.concat(F.lit("&"), bare)).when(name, F.concat(F.lit("@"), bare)).otherwise(bare)

    split = held(texts, "words", words)
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))))
    return held(split.where(F.size("words") > 0), "toks", F.zip_with("words", before, one)).drop("words")


def _windows(texts: DataFrame, name: str, width: int, values: bool = False) -> DataFrame:
    """(name, toks, i, key): a row for each window; with ``values`` the key tells slots of one type apart."""
    found = tokens(texts).select(name, "toks").where(F.size("toks") >= width)
    code = F.transform("toks", lambda t: F.xxhash64(t if values else F.when(F.substring(t, 1, 1).isin("#", "&", "@"), F.substring(t, 1, 1)).otherwise(t)))
    placed = held(found, "codes", code).select(name, "toks", "codes", F.explode(F.sequence(F.lit(0), F.size("codes") - width)).alias("i"))
    return placed.select(name, "toks", "i", F.xxhash64(*[F.get("codes", F.col("i") + j) for j in range(width)]).alias("key"))


def _slots(toks: Column, i: Column, width: int) -> Column:
    """Slots of the window at i. Nothing here breaks code generation, so that no row waits in a buffer with all tokens of its text."""
    five = [F.get(toks, i + j) for j in range(width)]
    return F.array_remove(F.array(*[F.when(F.substring(t, 1, 1).isin("#", "&", "@"), t).otherwise(F.lit("")) for t in five]), F.lit(""))


def _agreements(pairs: DataFrame, *of: str) -> DataFrame:
    """slot_agreement of each group ``of``: how often its values (was) stand for their most frequent value (now). pairs: (*of, was, now, n)."""
    values = pairs.groupBy(*of, "was", "now").agg(F.sum("n").alias("n"))
    return values.groupBy(*of, "was").agg(F.max("n").alias("most"), F.sum("n").alias("all")).groupBy(*of).agg((F.sum("most") / F.sum("all")).alias("slot_agreement"))


def _by_occurrence(hits: DataFrame, windows: DataFrame, sizes: DataFrame, hint: Callable[[DataFrame], DataFrame], width: int, share: float, agreement: float) -> DataFrame:
    """(doc, item, n_windows, n_item_windows, slot_agreement) of the best occurrence that is whole and consistent, of these hits."""
    places = windows.select("item", "key", F.explode("places").alias("of")).select("item", "key", F.col("of.i").alias("q"), F.col("of.slots").alias("was"))
    reach = places.groupBy("item").agg((F.max("q") + width).alias("reach"))
    matches = hits.select("doc", "item", "key", F.col("here").alias("now"), F.explode("at").alias("p")).join(hint(places.join(reach, "item")), ["item", "key"])
    matches = cut(matches.withColumn("d", F.col("p") - F.col("q")).drop("p"))
    anchors = matches.select("doc", "item", F.col("d").alias("a"), F.floor(F.col("d") / F.col("reach")).alias("block")).distinct()
    near = matches.withColumn("block", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor(F.col("d") / F.col("reach")) + k)))
    near = near.join(anchors, ["doc", "item", "block"]).withColumn("off", F.abs(F.col("d") - F.col("a"))).where("off <= reach")
    near = near.withColumn("wide", F.explode(F.when(F.col("off") == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(True)))))
    one = ["doc", "item", "a", "wide"]
    chosen = near.groupBy(*one, "q").agg(F.min(F.struct("off", "d", "key", "was", "now")).alias("m")).select(*one, "m.*")
    whole = chosen.groupBy(*one).agg(F.count_distinct("key").alias("n_windows")).join(hint(sizes), "item").where(F.col("n_windows") >= share * F.col("n_item_windows"))
    pairs = chosen.select(*one, F.explode(F.arrays_zip("was", "now")).alias("s")).select(*one, "s.was", "s.now", F.lit(1).alias("n"))
    sure = whole.join(_agreements(pairs, *one), one).where(F.col("slot_agreement") >= agreement)
    best = sure.groupBy("doc", "item", "n_item_windows").agg(F.max(F.struct("slot_agreement", "n_windows")).alias("b"))
    return best.select("doc", "item", "b.n_windows", "n_item_windows", "b.slot_agreement")


def _by_value(texts: DataFrame, items: DataFrame, width: int, share: float) -> DataFrame:
    """(doc, item, n_windows, n_item_windows, slot_agreement) of items whose windows stand in a document, slots and all."""
    windows = cut(_windows(items, "item", width, values=True).select("item", "key").distinct())
    hint = F.broadcast if windows.count() <= FEW_WINDOWS else (lambda df: df)
    sizes = windows.groupBy("item").agg(F.count("*").alias("n_item_windows"))
    met = _windows(texts, "doc", width, values=True).select("doc", "key").join(hint(windows), "key")
    counted = met.groupBy("doc", "item").agg(F.count_distinct("key").alias("n_windows")).join(hint(sizes), "item")
    return counted.where(F.col("n_windows") >= share * F.col("n_item_windows")).select("doc", "item", "n_windows", "n_item_windows", F.lit(1.0).alias("slot_agreement"))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = 5, literals: int = 3, share: float = 0.8, agreement: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each (document, item) found: id, item, n_windows (distinct ones that match), n_item_windows, slot_agreement."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    windows = _windows(items, "item", width).withColumn("slots", _slots(F.col("toks"), F.col("i"), width)).withColumn("plain", width - F.size("slots") >= literals)
    dense = cut(windows.groupBy("item").agg(F.bool_or("plain").alias("some")).where("not some").select("item"))
    windows = cut(windows.where("plain").groupBy("item", "key").agg(F.min("slots").alias("slots"), F.collect_list(F.struct("i", "slots")).alias("places")))
    sizes = windows.groupBy("item").agg(F.count("*").alias("n_item_windows"))
    small = windows.count() <= FEW_WINDOWS
    hint = F.broadcast if small else (lambda df: df)
    # items by window, so that a window shared by several items is met once
    by_key = windows.groupBy("key").agg(F.collect_list(F.struct("item", "slots")).alias("items")) if small else None
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = _windows(texts, "doc", width)
    if by_key is not None:
        met = found.join(hint(by_key), "key").select("doc", "key", "i", _slots(F.col("toks"), F.col("i"), width).alias("here"), F.explode("items").alias("of")).select("doc", "key", "i", "here", "of.item", "of.slots")
    else:
        met = found.select("doc", "key", "i", _slots(F.col("toks"), F.col("i"), width).alias("here")).join(windows, "key").select("doc", "key", "i", "here", "item", "slots")
    hits = cut(met.groupBy("doc", "item", "key", "here", "slots").agg(F.collect_list("i").alias("at")))
    counted = hits.groupBy("doc", "item").agg(F.count_distinct("key").alias("n_windows")).join(hint(sizes), "item").where(F.col("n_windows") >= share * F.col("n_item_windows"))
    pairs = hits.where(F.size("slots") > 0).select("doc", "item", F.size("at").alias("n"), F.explode(F.arrays_zip("slots", "here")).alias("s")).select("doc", "item", F.col("s.slots").alias("was"), F.col("s.here").alias("now"), "n")
    judged = cut(counted.join(_agreements(pairs, "doc", "item"), ["doc", "item"], "left").select("doc", "item", "n_windows", "n_item_windows", F.coalesce("slot_agreement", F.lit(1.0)).alias("slot_agreement")))
    out = judged.where(F.col("slot_agreement") >= agreement)
    torn = judged.where(F.col("slot_agreement") < agreement).select("doc", "item")
    if not torn.isEmpty():
        out = out.union(_by_occurrence(hits.join(torn, ["doc", "item"], "left_semi"), windows, sizes, hint, width, share, agreement))
    if not dense.isEmpty():
        out = out.union(_by_value(texts, items.join(dense, "item", "left_semi"), width, share))
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_windows", "n_item_windows", "slot_agreement")
