r"""Benchmark decontamination by template canonicalisation.

Benchmark items and documents become templates: marks are stripped, letters
lower-cased, and numbers, units after numbers, and names (capitalised words
inside a sentence) become typed placeholders.  Windows of ``width`` template
words are hash-joined, so a question whose values were changed still matches.
Matches of one item along one alignment then pass a slot check: the values in
the placeholders must map one to one (an item's 3 is always the document's 5,
and nothing else is).  An alignment with equal values is ``verbatim``, one
with a consistent change ``reparameterised``; an inconsistent one is no match.

Beside them, windows of the lower-cased words themselves are joined, with no
rule on names or values: a text in capitals or title case, or an item whose
first word follows a word, has other templates than the item and still its
words.  A window of equal words and values is ``verbatim`` by itself, whatever
the rest of its alignment holds.

Everything is DataFrame functions.  A document's window hashes of all widths
(items shorter than a window are windows of their own width) are computed in
one pass over the text; a fixed-size sieve of the benchmark's hashes drops most of them, the
rows made of the rest hold the document's key, a position and a hash only, and
are probed against the benchmark's windows, which are broadcast only when a
count proves them small.  Texts are met again for the documents with a
match alone, to compare the windows themselves and their slots.

Cases: null or empty texts hold no windows and are clean; a window with fewer literal words than half of
it identifies no template and is matched by its words alone; repeated rows are judged alike;
null ids are kept; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import once, stored
from riskview.operators.joins import broadcast_if_small

#: Units that a number may carry, lower case.
UNITS = ("mm", "cm", "m", "km", "in", "ft", "yd", "mi", "mg", "g", "kg", "t", "oz", "lb", "ml", "cl", "l", "s", "sec",
         "min", "h", "hr", "hrs", "hours", "minutes", "seconds", "days", "weeks", "months", "years", "meters", "metres",
         "miles", "grams", "litres", "liters", "pounds", "dollars", "euros", "usd", "eur", "percent")
_MARKS = r"""[.,;:!?"'()\[\]{}«»„“”‘’…*#%&$|<>]+"""
_NAME = "\u0001"  # put before a name; taken out of texts first
_SPACE = r"[\x20\x09-\x0D]"


# Values used more than once are bound by ``once``: inside functions of array
# elements nothing else keeps Spark from computing them again at each use.

def _plain(text: Column) -> Column:
    """Text without marks, each name led by a control character."""
    def clean(t: Column) -> Column:
        t = F.when(F.contains(t, F.lit(_NAME)), F.replace(t, F.lit(_NAME), F.lit(" "))).otherwise(t)
        # the capital is tried first: a lookbehind at every character would be slow
        named = F.regexp_replace(t, r"(\p{Lu})(?<=[^.!?:\x20\x09-\x0D][\x20\x09]\p{Lu})", _NAME + "$1")
        return F.regexp_replace(named, _MARKS, "")
    return once(F.coalesce(text, F.lit("")), clean)


def _template(low: Column) -> Column:
    """Template of a plain text in lower case, one word for each of its words."""
    word = _SPACE.replace("[", "[^")

    def names(low: Column) -> Column:
        return F.when(F.contains(low, F.lit(_NAME)), F.regexp_replace(low, f"{_NAME}{word}*", "<name>")).otherwise(low)

    def numbers(low: Column) -> Column:
        digits = F.regexp_replace(low, rf"{word}*[0-9]{word}*", "<number>")
        units = F.regexp_replace(digits, rf"(?<=<number>{_SPACE})(?:" + "|".join(UNITS) + rf")(?!{word})", "<unit>")
        return F.when(low.rlike("[0-9]"), units).otherwise(low)

    return once(once(low, names), numbers)


def _words(text: Column) -> Column:
    return once(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), lambda t: F.when(
        t == "", F.array().cast("array<string>")).otherwise(F.split(t, _SPACE + "+")))


def _views(text: Column) -> Column:
    """A text's words twice, one for one: template and lower-cased words."""
    return once(F.lower(_plain(text)), lambda low: F.struct(
        _words(_template(low)).alias("template"), _words(F.replace(low, F.lit(_NAME), F.lit(""))).alias("words")))


def _word_hashes(words: Column) -> Column:
    return once(words, lambda w: F.transform(w, lambda x: F.xxhash64(x)))


def _hashes(single: Column, width: int) -> Column:
    """Hash of every window of ``width`` words from the words' hashes, by
    doubling: a window's hash is that of its halves' hashes, so each step is
    one pass over an array."""
    def joined(left: Column, right: Column, shift: int) -> Column:
        return once(F.struct(left.alias("l"), right.alias("r")), lambda h: F.zip_with(
            h["l"], F.slice(h["r"], shift + 1, F.greatest(F.size(h["r"]) - shift, F.lit(0))), lambda x, y: F.xxhash64(x, y)))

    def wide(hashes: Column, n: int) -> Column:
        """Hashes of windows of ``n``; the last ``n - 1`` entries are void."""
        if n == 1:
            return hashes
        half = 1 << (n - 1).bit_length() - 1
        return once(hashes, lambda h: once(wide(h, half), lambda a: joined(
            a, a if n == 2 * half else wide(h, n - half), half)))

    return once(single, lambda h: F.slice(wide(h, width), 1, F.greatest(F.size(h) - width + 1, F.lit(0))))


def _is_slot(word: Column) -> Column:
    return word.isin("<name>", "<number>", "<unit>")


def _slots(template: Column, words: Column) -> Column:
    """Values of a window's placeholders (empty string elsewhere)."""
    return F.zip_with(template, words, lambda t, w: F.when(_is_slot(t), w).otherwise(F.lit("")))


def _firm(template: Column, width: Column) -> Column:
    """Whether a window has literal words enough to identify a template."""
    return 2 * F.size(F.filter(template, lambda x: ~_is_slot(x))) >= width


def _item_windows(items: DataFrame, widths: list[int]) -> DataFrame:
    """Windows of the items, by template and (``literal``) by words: item,
    item_at, width, item_window, item_words, literal, hash."""
    last = F.size("template") - F.col("width")
    rows = items.withColumn("item_at", F.explode(F.sequence(F.lit(0), last)))
    window = lambda c: F.slice(c, F.col("item_at") + 1, F.col("width"))
    rows = rows.select("item", "item_at", "width", window("template").alias("item_window"), window("words").alias("item_words"))
    rows = rows.withColumn("literal", F.explode(F.array(F.lit(False), F.lit(True))))
    words = F.when(F.col("literal"), F.col("item_words")).otherwise(F.col("item_window"))

    def whole(width: int) -> Column:
        return F.when(F.col("width") == width, once(_word_hashes(words), lambda h: F.element_at(_hashes(h, width), 1)))

    hashed = F.coalesce(*map(whole, widths))
    return rows.where(F.col("literal") | _firm(F.col("item_window"), F.col("width"))).withColumn("hash", hashed)


_SIEVE = 18  # bits of a hash that the sieve looks at


def _sieve(windows: DataFrame) -> Column:
    """A bit for each value of a hash's last bits that a window has, as an
    array of longs: of a fixed size, whatever the benchmark."""
    low = F.col("hash").bitwiseAND(F.lit((1 << _SIEVE) - 1))
    bits = (windows.groupBy(F.shiftright(low, 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 AS INT))")).alias("bits")).collect())
    longs = [0] * (1 << _SIEVE - 6)
    for r in bits:
        longs[r["at"]] = r["bits"]
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def _sifted(hashes: Column, sieve: Column, literal: bool, width: int) -> Column:
    """Position, hash, kind and width of the windows that the sieve does not rule out."""
    low = lambda h: h.bitwiseAND(F.lit((1 << _SIEVE) - 1))
    return once(sieve, lambda bits: F.filter(
        F.transform(hashes, lambda h, i: F.when(F.bit_get(
            F.element_at(bits, (F.shiftright(low(h), 6) + 1).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1,
            F.struct(i.alias("at"), h.alias("hash"), F.lit(literal).alias("literal"),
            F.lit(width).alias("width")))), lambda x: x.isNotNull()))


def _matches(texts: DataFrame, items: DataFrame, widths: list[int]) -> DataFrame:
    """Windows of documents equal to an item's: id, key, item, shift, the slot
    values of both, and ``exact``: verbatim by itself, whatever the rest of its
    alignment.  ``texts``: id, key, text."""
    kind = ["hash", "literal", "width"]
    parts = [*kind, "item_window", "item_words"]
    listed = stored(_item_windows(items, widths), "item-rows")
    own = stored(listed.select(parts).distinct().withColumn("window_id", F.monotonically_increasing_id()), "item-windows")
    owners = stored(listed.join(own, parts).select("window_id", "item", "item_at"), "window-items")
    sieves = {(literal, w): _sieve(own.where((F.col("literal") == literal) & (F.col("width") == w)))
              for literal in (False, True) for w in widths}

    def of_view(words: Column, literal: bool) -> Column:
        return once(_word_hashes(words), lambda h: F.concat(*[
            _sifted(_hashes(h, w), sieves[literal, w], literal, w) for w in widths]))

    sifted = once(_views(F.col("text")), lambda v: F.concat(of_view(v["template"], False), of_view(v["words"], True)))
    met = texts.select("id", "key", F.explode(sifted).alias("w")).select("id", "key", "w.at", *[f"w.{c}" for c in kind])
    found = stored(met.join(broadcast_if_small(own.select(kind).distinct(), 1_000_000), kind), "window-hits")
    # at most two entries a window of the text, however many items or equal rows
    found = stored(found.groupBy("id", "key").agg(F.collect_set(F.struct("at", *kind)).alias("hits"))
                   .toDF("hit_id", "hit_key", "hits"), "document-hits")
    # the texts of documents with a hit only, each once
    same = (F.col("key") == F.col("hit_key")) & F.col("id").eqNullSafe(F.col("hit_id"))
    rows = texts.join(broadcast_if_small(found.select("hit_id", "hit_key")), same, "left_semi").dropDuplicates(["id", "key"])
    rows = rows.join(found, same)
    hits = once(_views(F.col("text")), lambda v: F.transform("hits", lambda h: F.struct(
        h["at"].alias("at"), *[h[c].alias(c) for c in kind],
        F.slice(v["template"], h["at"] + 1, h["width"]).alias("window"), F.slice(v["words"], h["at"] + 1, h["width"]).alias("words"))))
    rows = rows.select("id", "key", F.explode(hits).alias("hit")).select("id", "key", "hit.*")
    rows = rows.join(broadcast_if_small(own, 100_000), kind)
    # equal words are verbatim; equal templates are judged by their alignment's slots
    rows = rows.where(F.when(F.col("literal"), F.col("words") == F.col("item_words")).otherwise(F.col("window") == F.col("item_window")))
    rows = rows.select("id", "key", "at", "window_id", F.col("literal").alias("exact"),
                       _slots(F.col("item_window"), F.col("item_words")).alias("item_slots"), _slots(F.col("item_window"), F.col("words")).alias("slots"))
    # items last, as rows: a document may hold windows that very many items share
    rows = rows.join(broadcast_if_small(owners, 100_000), "window_id")
    return rows.select("id", "key", "item", (F.col("at") - F.col("item_at")).alias("shift"), "exact", "item_slots", "slots")


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 8, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every document's id, key (of id and text), contaminated, n_items, and
    items: the matched item ids with how they match."""
    items = (benchmark.select(F.col(item_col).alias("item"), _views(F.col(item_text_col)).alias("views"))
             .select("item", "views.template", "views.words")
             .where(F.size("template") > 0).withColumn("width", F.least(F.size("template"), F.lit(width))))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most ``width`` numbers
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = rows.withColumn("key", F.xxhash64("id", "text"))
    if not widths:
        none = F.array().cast(f"array<struct<item:{items.schema['item'].dataType.simpleString()},kind:string>>")
        return keyed.select(F.col("id").alias(id_col), "key", F.lit(False).alias("contaminated"),
                            F.lit(0).cast("long").alias("n_items"), none.alias("items"))
    hits = _matches(keyed, items, widths)
    pairs = F.when(~F.col("exact"), F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"] != ""))
    # an alignment has at most one pair a slot of its item
    runs = (hits.withColumn("pair", F.explode_outer(F.array_distinct(pairs)))
            .groupBy("id", "key", "item", "shift").agg(F.collect_set("pair").alias("pairs"), F.max("exact").alias("exact")))
    given, taken = F.array_distinct(F.col("pairs.item_slots")), F.array_distinct(F.col("pairs.slots"))
    same = F.col("exact") | F.forall("pairs", lambda p: p["item_slots"] == p["slots"])
    runs = (runs.where(F.col("exact") | (F.size("pairs") == F.size(given)) & (F.size("pairs") == F.size(taken)))
            .groupBy("id", "key", "item").agg(F.max(same).alias("same")))
    kind = F.when(F.col("same"), "verbatim").otherwise("reparameterised")
    found = stored(runs.groupBy("id", "key").agg(
        F.sort_array(F.collect_list(F.struct("item", kind.alias("kind")))).alias("items")), "contaminated")
    found = broadcast_if_small(found.select(F.col("id").alias("found_id"), F.col("key").alias("found_key"), "items"))
    out = keyed.select("id", "key").join(found, (F.col("key") == F.col("found_key")) & F.col("id").eqNullSafe(F.col("found_id")), "left")
    return out.select(F.col("id").alias(id_col), "key", F.col("items").isNotNull().alias("contaminated"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items", F.array().cast(found.schema["items"].dataType)).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents, all columns, that hold no benchmark passage."""
    bad = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **how).where("contaminated")
    bad = broadcast_if_small(stored(bad.select(F.col(id_col).alias("bad_id"), F.col("key").alias("bad_key")).distinct(), "leaks"))
    same = (F.xxhash64(docs[id_col], docs[text_col]) == bad["bad_key"]) & docs[id_col].eqNullSafe(bad["bad_id"])
    return docs.join(bad, same, "left_anti")
