"""Benchmark decontamination by template windows.

Text is reduced to a template: words are lower-cased and stripped of punctuation, and names (capitalised
words, wherever they stand), numbers and units become typed placeholders. Hyphens part words. Windows of consecutive template words are hash-joined with the
windows of the benchmark items, so an item is found again when only its numbers, names or units were
changed. So are windows of the plain lower-cased words, and a place of an item is found by either kind. The values that fill the placeholders must then be consistent: where an item has the same
value in several places, the copy must have equal values in more than half of these places. An item whose
plain words are found in ``min_share`` of its windows needs no such check.

A document holds an item if at least ``min_share`` of the item's windows occur in it and its slots are
consistent. The benchmark side is broadcast only if its measured size allows it.

Cases: null or empty text holds nothing, and null or empty items are held by nothing. An item shorter
than the window is one window of all its words, and documents are cut into windows of each such length
too. Item windows with more placeholders than words say little; only their plain words are compared. Repeated rows of one ``doc_id`` are judged together and give one row per
item; so do repeated items with the same ``item_id``. A copy in another case has no names: it is found by
its plain words, but not where its names or, beside a name, its numbers were changed as well. A null ``doc_id`` or ``item_id`` is an
id like any other. ``drop_contaminated`` judges all rows of an id together, ``drop_contaminated_texts`` each text by
itself, so that a clean row never goes for another row with its id. Extra columns are ignored, empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import fresh_name, query, table, without
from cuadra.session import broadcast_if_small, written_once

WINDOW = 8
MIN_SHARE = 0.4

NAME, NUMBER, UNIT = "_name_", "_number_", "_unit_"

# Unit symbols and words that may follow a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb lbs oz ml cl dl l s sec min h hr hrs ms kmh mph hz khz mhz ghz w kw mw v a "
    "j kj cal kcal n pa kpa bar k c f usd eur gbp meter meters metre metres kilometer kilometers gram grams kilogram "
    "kilograms liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year "
    "years mile miles inch inches foot feet yard yards pound pounds ounce ounces dollar dollars euro euros cent cents percent"
).split()

# A capitalised word, wherever it stands.
# The first letter is looked at before what stands around it: most places fail there.
_NAME_AT = r"(?=\p{Lu})(?<![\p{L}\p{N}\p{M}_])\p{Lu}[\p{Ll}\p{M}]+(?![\p{L}\p{N}_])"
_HYPHENS = "\u2010\u2011\u2012\u2013\u2014\u2212-"
_PUNCTUATION = rf"[^\p{{L}}\p{{N}}\p{{M}}\s_{_HYPHENS}]+"
# What becomes one space: runs of white space and hyphens, but not the single space that is there already.
# Letters and digits are passed over first: nearly all places hold one.
_GAPS = rf"(?![A-Za-z0-9])(?:[\t\n\x0B\f\r{_HYPHENS}][\s{_HYPHENS}]*| [\s{_HYPHENS}]+)"
_DIGIT_BEFORE_LETTER = r"(\p{N})(?=\p{L})"
_NUMBER_AT = r"(?=\p{N})(?<![\p{L}\p{N}_])\p{N}+(?![\p{L}\p{N}_])"
_UNIT_AT = rf"{NUMBER} (?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}_])"


def clean(text: Column) -> Column:
    """Text without punctuation, in its case; decimal and thousands marks inside numbers go too.

    Hyphens part words, and a number is parted from a unit written behind it.
    """
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), _PUNCTUATION, "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, _DIGIT_BEFORE_LETTER, "$1 "), _GAPS, " "))


def values(cleaned: Column) -> Column:
    """The words as they stand, one for each template word."""
    return F.split(F.lower(cleaned), " ")


def template(cleaned: Column) -> Column:
    """The template words of a text; the text's own look-alikes of placeholders are no special case."""
    # Each word stays one word. A name is marked before the case is lost.
    named = F.regexp_replace(cleaned, _NAME_AT, NAME)
    numbered = F.regexp_replace(F.lower(named), _NUMBER_AT, NUMBER)
    return F.split(F.regexp_replace(numbered, _UNIT_AT, f"{NUMBER} {UNIT}"), " ")


def _is_slot(word: Column) -> Column:
    return word.isin(NAME, NUMBER, UNIT)


def with_windows(df: DataFrame, source: str, widths: Iterable[int]) -> DataFrame:
    """``df`` with a column ``source``_w for each width w: the hash of the w words that begin at each place.

    ``source`` holds word hashes. A window is hashed from two shorter ones, so a step looks at two numbers
    for each word, whatever the width. Each step is a column of its own, or it would be worked out again wherever
    it is used.
    """
    needed, todo = set(), list(widths)
    while todo:
        w = todo.pop()
        if w not in needed:
            needed.add(w)
            todo += _halves(w)
    for w in sorted(needed):
        if w == 1:
            df = df.withColumn(f"{source}_1", F.col(source))
            continue
        first, second = _halves(w)
        count = F.greatest(F.size(source) - (w - 1), F.lit(0))
        df = df.withColumn(f"{source}_{w}", F.zip_with(
            F.slice(f"{source}_{first}", 1, count), F.slice(f"{source}_{second}", first + 1, count), lambda a, b: F.xxhash64(a, b)))
    return df


def _halves(w: int) -> list[int]:
    """The largest power of two below ``w``, and the rest."""
    return [] if w < 2 else [p := 1 << (w - 1).bit_length() - 1, w - p]


def _places(w: int) -> Column:
    """at, hash and second: the template windows of w words, then the plain ones where they differ."""
    typed, plain = f"_typed_{w}", f"_plain_{w}"
    both = F.concat(
        F.transform(typed, lambda h, i: F.struct(i.alias("at"), h.alias("hash"), F.lit(False).alias("second"))),
        F.transform(plain, lambda h, i: F.struct(i.alias("at"), F.when(h != F.get(F.col(typed), i), h).alias("hash"), F.lit(True).alias("second"))))
    return F.filter(both, lambda x: x["hash"].isNotNull())


def _worded(df: DataFrame, key: str) -> DataFrame:
    """key, _t (template words) and _v (plain words); a text without words has one empty word."""
    return df.select(key, clean(F.col("text")).alias("_c")).select(key, template(F.col("_c")).alias("_t"), values(F.col("_c")).alias("_v"))


def _coded(words: DataFrame) -> DataFrame:
    """``words`` with the hashes of template and plain words, _typed and _plain."""
    coded = lambda c: F.transform(c, lambda w: F.xxhash64(w))
    return words.select("*", coded("_t").alias("_typed"), coded("_v").alias("_plain"))


def _anchor(w: int) -> tuple[int, int]:
    """Stride and length of anchors: of the runs of so many words at every ``stride``-th place, one lies inside each window of w words."""
    stride = max(w // 2, 1)
    return stride, w - stride + 1


def _run_hash(words: Column | str, length: int, at: Column) -> Column:
    """The hash of ``length`` words from place ``at``, counted from 0."""
    return F.xxhash64(F.slice(words, at + 1, length))


def _probes(h: Column) -> list[tuple[Column, Column]]:
    """Slot and bit of a hash in three independent places of a bitmap."""
    parts = [F.shiftrightunsigned(h, 21 * k).bitwiseAND(F.lit((1 << 21) - 1)) for k in range(3)]
    return [(F.shiftright(p, 6).cast("int"), p.bitwiseAND(F.lit(63)).cast("int")) for p in parts]


def _bitmap(hashes: DataFrame) -> DataFrame:
    """One row with 2^15 numbers whose bits tell which hashes may be there: 256 KB, whatever the number of hashes."""
    places = hashes.select(F.explode(F.array(*[F.struct(slot.cast("long").alias("slot"), bit.alias("bit")) for slot, bit in _probes(F.col("_hash"))])).alias("p"))
    set_bits = places.select("p.slot", F.expr("shiftleft(1L, p.bit)").alias("bits"))
    every = set_bits.unionByName(hashes.sparkSession.range(1 << 15).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("bits")))
    slots = every.groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    return slots.agg(F.sort_array(F.collect_list(F.struct("slot", "bits"))).getField("bits").alias("_bits"))  # one entry for each slot


def _may_be(h: Column) -> Column:
    """Whether the bitmap beside the row has all three bits of a hash; it says yes too often, never no."""
    tests = [F.call_function("shiftright", F.get(F.col("_bits"), slot), bit).bitwiseAND(F.lit(1)) == 1 for slot, bit in _probes(h)]
    return reduce(lambda a, b: a & b, tests)


def _with_anchors(words: DataFrame, widths: Sequence[int], inner: DataFrame) -> DataFrame:
    """The rows of ``words`` with an anchor, of either kind, that an item's window may hold (``inner``: _hash). No window is lost."""
    tests = []
    for w in widths:
        stride, length = _anchor(w)
        for c in ("_t", "_v"):
            places = F.sequence(F.lit(0), F.greatest(F.size(c) - length, F.lit(0)), F.lit(stride))
            tests.append(F.exists(F.transform(places, partial(_run_hash, c, length)), _may_be))
    return words.join(F.broadcast(written_once(_bitmap(inner))), reduce(lambda a, b: a | b, tests), "left_semi")


def _document_windows(docs: DataFrame, widths: Sequence[int], sought: DataFrame) -> DataFrame:
    """doc_id, _at and _hash of the windows of each width, both kinds, of all documents that may hold a sought hash."""
    # Most documents hold nothing. A few runs of words show it for most of them, before any window is hashed,
    # and a bitmap of the windows for others, before any window becomes a row.
    near = _with_anchors(_worded(docs, "doc_id"), widths, sought.select(F.explode("_inner").alias("_hash")))
    rows = with_windows(with_windows(_coded(near), "_typed", widths), "_plain", widths)
    some = reduce(lambda a, b: a | b, [F.exists(f"{c}_{w}", _may_be) for w in widths for c in ("_typed", "_plain")])
    rows = rows.join(F.broadcast(written_once(_bitmap(sought))), some, "left_semi")
    each = reduce(DataFrame.unionByName, [rows.select("doc_id", F.explode(_places(w)).alias("_w")) for w in widths])
    return each.select("doc_id", F.col("_w.at").alias("_at"), F.col("_w.hash").alias("_hash"))


def _item_windows(items: DataFrame, width: int) -> DataFrame:
    """item_id, _at, _hash, _plain (no placeholder inside), _width and _inner. Template windows that are mostly placeholders are left out.

    ``_inner`` holds the hashes of all runs inside the window that may be an anchor in a document.
    """
    widths = range(1, width + 1)
    rows = with_windows(with_windows(_coded(_worded(items, "item_id")), "_typed", widths), "_plain", widths).filter("_t[0] != ''")
    each = reduce(DataFrame.unionByName, [
        rows.filter(F.least(F.lit(width), F.size("_t")) == w).select("item_id", "_t", "_v", F.lit(w).alias("_width"), F.explode(_places(w)).alias("_w")).withColumn(
            "_inner", _runs_inside(w)) for w in widths])
    slots = F.size(F.filter(F.slice("_t", F.col("_w.at") + 1, F.col("_width")), _is_slot))
    return each.filter(F.col("_w.second") | (slots * 2 <= F.col("_width"))).select(
        "item_id", F.col("_w.at").alias("_at"), F.col("_w.hash").alias("_hash"), (F.col("_w.second") | (slots == 0)).alias("_plain"), "_width", "_inner")


def _runs_inside(w: int) -> Column:
    """The hashes of the runs of an anchor's length inside the window ``_w`` of w words."""
    stride, length = _anchor(w)
    words = F.when(F.col("_w.second"), F.col("_v")).otherwise(F.col("_t"))
    return F.array(*[_run_hash(words, length, F.col("_w.at") + k) for k in range(stride)])


def find_items(docs: DataFrame, items: DataFrame, width: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, item_id, windows (of the item, found), item_windows and share."""
    known = items.select("item_id", "text")
    mine = written_once(_item_windows(known, width).distinct())
    widths = sorted(r._width for r in mine.select("_width").distinct().collect())  # no more than ``width``
    sizes = mine.groupBy("item_id").agg(F.count_distinct("_at").alias("item_windows"))
    sought = mine.select("item_id", F.col("_at").alias("_item_at"), "_hash", "_plain")

    # One row per document, item and shift between the two: where the copy starts in the document.
    hits = _document_windows(docs, widths or [width], mine).join(broadcast_if_small(sought), "_hash")
    runs = hits.groupBy("doc_id", "item_id", (F.col("_at") - F.col("_item_at")).alias("_shift")).agg(
        F.collect_set("_item_at").alias("_places"),  # no more than the item has windows
        F.collect_set(F.when(F.col("_plain"), F.col("_item_at"))).alias("_same"),
    )
    runs = written_once(runs)
    places = runs.select("doc_id", "item_id", "_same", F.explode("_places").alias("_place"))
    places = places.groupBy("doc_id", "item_id", "_place").agg(F.max(F.array_contains("_same", F.col("_place")).cast("int")).alias("_plain"))
    seen = places.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("windows"), F.sum("_plain").alias("_plain"))
    share = F.col("windows") / F.col("item_windows")
    known_sizes = broadcast_if_small(sizes.withColumnRenamed("item_id", "_i"))
    found = seen.join(known_sizes, F.col("item_id").eqNullSafe(F.col("_i"))).drop("_i").withColumn("share", share).filter(F.col("share") >= min_share)
    found = written_once(found)
    # What is there word for word needs no check of its slots.
    doubtful = found.filter(F.col("_plain") / F.col("item_windows") < min_share)
    wrong = _inconsistent(docs, known, runs, doubtful, width)
    return without(found, wrong, ("doc_id", "item_id")).select("doc_id", "item_id", "windows", "item_windows", "share")


def _inconsistent(docs: DataFrame, known: DataFrame, runs: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """Pairs in which, in every run, half or more of the slots with a repeated value do not agree with another one of that value."""
    slots = known.select("item_id", clean(F.col("text")).alias("_c")).select("item_id", template(F.col("_c")).alias("_t"), values(F.col("_c")).alias("_v")).select(
        "item_id", F.posexplode(F.arrays_zip("_t", "_v")).alias("_slot", "_z")
    ).filter(_is_slot(F.col("_z._t"))).select("item_id", "_slot", F.col("_z._v").alias("_value"), F.col("_z._t").alias("_type"))
    # Only values that an item repeats can contradict.
    repeated = slots.groupBy("item_id", "_type", "_value").agg(F.collect_set("_slot").alias("_slots")).filter("size(_slots) > 1")
    repeated = written_once(repeated)
    empty = found.select("doc_id", "item_id").limit(0)
    if repeated.isEmpty():
        return empty
    asked = runs.join(broadcast_if_small(found.select(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i"))),
                      F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("item_id").eqNullSafe(F.col("_i")), "left_semi")
    asked = written_once(
        asked.join(broadcast_if_small(repeated.withColumnRenamed("item_id", "_i")), F.col("item_id").eqNullSafe(F.col("_i")))
        .select("doc_id", "item_id", "_shift", "_places", "_type", "_value", F.explode("_slots").alias("_slot"))
        # The slot must lie inside a window that was found in this run.
        .filter(F.exists("_places", lambda p: (p <= F.col("_slot")) & (F.col("_slot") < p + width)))
        .select("doc_id", "item_id", "_shift", "_type", "_value", (F.col("_slot") + F.col("_shift")).alias("_at"))
    )
    ids = broadcast_if_small(asked.select(F.col("doc_id").alias("_d")).distinct())
    words = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi").select(
        F.col("doc_id").alias("_d"), values(clean(F.col("text"))).alias("_v"))
    filled = asked.join(words, F.col("doc_id").eqNullSafe(F.col("_d"))).withColumn(
        "_got", F.get(F.col("_v"), F.col("_at").cast("int")))
    run = ["doc_id", "item_id", "_shift"]
    same = filled.groupBy(*run, "_type", "_value", "_got").agg(F.count_distinct("_at").alias("_n"))
    agree = same.groupBy(*run, "_type", "_value").agg(F.sum("_n").alias("_of"), F.max("_n").alias("_most")).filter("_of > 1")
    odd = F.sum(F.col("_of") - F.when(F.col("_most") > 1, F.col("_most")).otherwise(0))
    judged = agree.groupBy(*run).agg((2 * odd >= F.sum("_of")).alias("_clash"))
    return judged.groupBy("doc_id", "item_id").agg(F.min("_clash").alias("_clash")).filter("_clash").select("doc_id", "item_id")


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    return without(docs, find_items(docs, items, width, min_share))


def drop_contaminated_texts(docs: DataFrame, items: DataFrame, width: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` whose own text holds no benchmark item, whatever their ids, with their columns."""
    key = fresh_name(docs, "text_md5")
    keyed = docs.withColumn(key, F.md5(F.coalesce(F.col("text"), F.lit(""))))
    texts = keyed.select(F.col(key).alias("doc_id"), "text")
    found = find_items(texts, items, width, min_share).select(F.col("doc_id").alias(key))
    return without(keyed, found, (key,)).drop(key)


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
