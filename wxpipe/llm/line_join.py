"""Line de-duplication by a segment-partition edit join.

A line goes if the same line, or one within ``edits`` edits of it, appears earlier: in a document
with a smaller id, or further up in its own. Earlier lines are those of the input, so the result
does not depend on the order in which lines are removed. How many edits count as near follows the
shorter line's length: one for every ``chars_per_edit`` characters, up to ``edits``; the shortest
lines, in which a single edit makes another word, must be equal. Lines without a word are not
compared.

Two lines within k edits share one of k + 1 segments of the shorter one, at a place that the
lengths bound. Each line is indexed by its own segments and probes the substrings that could be
segments of lines as long or a little shorter; an index key holds the length, the segment's number
and its text. Keys that only one line uses fall away. Lines that share one of the
others are compared by two words of parities first, of their characters and of their character
pairs, of which an edit can change two and four bits; so of the many lines that share a common
segment only pairs that may be near leave the join. The built-in banded Levenshtein distance
confirms them on the texts. (The bit-parallel form of that check needs arithmetic on machine
words per character that SQL has no function for.)

Spark expressions only. Lines travel as 128-bit hashes; only texts of candidates are shuffled.
A line that many documents hold is joined once: repeats are set aside before the join.

Defined cases: null texts have no lines; rows without id keep all their lines; rows that repeat
an id are one document and keep the same lines; equal lines in one document count as earlier by
line number; very long texts are cut into lines inside their row; an empty table gives no rows; extra
columns are ignored by :func:`duplicate_lines`
and passed through by :func:`drop_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .common import fresh, is_small, let, matching, sized_for

EDITS = 2
CHARS_PER_EDIT = 10
#: A line that appears more often is set aside before lines are dealt out by segment.
HOT = 1000
WORD_CHAR = "[^\\x20\\x09-\\x0D]"
_SPACES = " \t\n\x0b\x0c\r"
_INDEX, _PROBE = 1, 2
#: Bytes of the largest shuffle, in bytes of text.
SHUFFLED = 2


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, line and the two halves of the line's hash, for every line with a word."""
    narrow = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    cut = narrow.where(F.col("key").isNotNull()).select("key", F.posexplode(F.split("text", "\n", -1)))
    return cut.where(F.ltrim("col", F.lit(_SPACES)) != "").select(
        "key",
        "pos",
        F.col("col").alias("line"),
        F.xxhash64("col").alias("h"),
        F.xxhash64(F.lit(7), F.col("col")).alias("g"),
    )


def _allowed(chars: Column, edits: int, chars_per_edit: int) -> Column:
    """Edits by which a longer line may differ from one of ``chars`` characters."""
    return F.least(F.lit(edits), F.floor(chars / chars_per_edit).cast("int"))


def _segment(length: Column, allowed: int, i: int) -> tuple[Column, Column]:
    """Start (from 1) and size of segment ``i`` of lines of ``length`` characters.

    There is one more than ``allowed``; they differ by one character at most, the longer ones last.
    """
    parts = allowed + 1
    longer = F.pmod(length, F.lit(parts))
    short = F.floor(length / parts).cast("int")
    extra = F.greatest(F.lit(0), F.lit(i - parts) + longer)
    return i * short + extra + 1, short + (longer >= parts - i).cast("int")


def _probe_keys(edits: int, chars_per_edit: int) -> tuple[Column, list[int]]:
    """Keys of all substrings that a line probes with, and which of them are its own segments.

    A key is null where lines of that length allow another number of edits.
    """
    keys, own = [], []
    for allowed in range(1, edits + 1):
        for fewer in range(allowed + 1):
            length = F.col("chars") - fewer
            here = _allowed(length, edits, chars_per_edit) == allowed
            for i in range(allowed + 1):
                start, size = _segment(length, allowed, i)
                low = max(-i, fewer - (allowed - i))
                high = min(i, fewer + (allowed - i))
                for shift in range(low, high + 1):
                    if fewer == 0 and shift == 0:
                        own.append(len(keys))
                    part = F.substr(F.col("line"), start + shift, size)
                    keys.append(F.when(here, F.xxhash64(F.lit(i), length, part)))
    return F.array(*keys), own


def _segments(lines: DataFrame, edits: int, chars_per_edit: int) -> DataFrame:
    """(h, segment, role) of every line: the keys it probes with; its own ones index it too."""
    sized = lines.select("h", "line", F.length("line").alias("chars"))
    long = sized.where(F.col("chars") >= chars_per_edit)
    keys, own = _probe_keys(edits, chars_per_edit)
    dealt = long.select("h", F.posexplode(keys).alias("n", "segment")).where("segment IS NOT NULL")
    role = F.when(F.col("n").isin(*own), _INDEX | _PROBE).otherwise(_PROBE)
    return dealt.select("h", "segment", role.alias("role"))


def _parities(line: Column) -> Column:
    """Two words of 64 parities: how often characters, and pairs of them, occur."""
    chars = F.split(line, "")

    def word(parts: Column) -> Column:
        bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))
        return F.aggregate(F.transform(parts, bit), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseXOR(b))

    pairs = lambda x: F.zip_with(x, F.slice(x, 2, F.size(x)), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return let(chars, lambda x: F.struct(word(x).alias("ones"), word(pairs(x)).alias("twos")))


def _without_hot_repeats(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """Lines, those that appear more than ``HOT`` times only where they appear first.

    At most one line in ``HOT`` can be so frequent; what is left of any one line fits a task.
    """
    hot = firsts.where(F.col("n") > HOT).select("h", "g", "first")
    if is_small(hot, 64):
        hot = F.broadcast(hot)
    first = F.col("first").isNull() | (F.col("first") == F.struct("key", "pos"))
    return lines.join(hot, ["h", "g"], "left").where(first)


def near_lines(
    lines: DataFrame, firsts: DataFrame, staging: Staging, edits: int, chars_per_edit: int
) -> DataFrame:
    """Both directions of every pair of different near lines: (h, g) and (h2, g2)."""
    dealt = _segments(_without_hot_repeats(lines, firsts), edits, chars_per_edit)
    users = Window.partitionBy("segment")
    used = (
        dealt.withColumn("low", F.min("h").over(users))
        .withColumn("high", F.max("h").over(users))
        .withColumn("roles", F.bit_or("role").over(users))
        .where((F.col("low") < F.col("high")) & (F.col("roles") == _INDEX | _PROBE))
    )
    used = staging.write(used.groupBy("segment", "h").agg(F.bit_or("role").alias("role")), "probes")
    named = used.select("h").distinct()
    texts = matching(lines.select("h", "g", "line"), named, "h", "left_semi").dropDuplicates(["h", "g"])
    texts = staging.write(texts.withColumn("parity", _parities(F.col("line"))), "texts")
    marked = used.join(texts.select("h", "parity"), "h")
    index = marked.where(F.col("role").bitwiseAND(F.lit(_INDEX)) != 0).select("segment", "h", "parity")
    probes = marked.select("segment", F.col("h").alias("h2"), F.col("parity").alias("parity2"))
    differ = lambda part: F.bit_count(F.col(f"parity.{part}").bitwiseXOR(F.col(f"parity2.{part}")))
    able = (F.col("h") != F.col("h2")) & (differ("ones") <= 2 * edits) & (differ("twos") <= 4 * edits)
    pairs = (
        index.alias("i")
        .join(probes.alias("p"), (F.col("i.segment") == F.col("p.segment")) & able)
        .select(F.least("h", "h2").alias("h"), F.greatest("h", "h2").alias("h2"))
        .distinct()
    )
    pairs = staging.write(pairs, "candidates")
    texts = texts.drop("parity")
    other = texts.select(F.col("h").alias("h2"), F.col("g").alias("g2"), F.col("line").alias("line2"))
    shorter = F.least(F.length("line"), F.length("line2"))
    distance = F.levenshtein("line", "line2", edits)
    close = (distance >= 0) & (distance <= _allowed(shorter, edits, chars_per_edit))
    found = pairs.join(texts, "h").join(other, "h2").where(close).select("h", "g", "h2", "g2")
    found = staging.write(found, "near")
    return found.union(found.select("h2", "g2", "h", "g"))


def duplicate_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """``key``, removed (line numbers from 0) and n_links of documents with repeated or near lines.

    n_links sums, over the document's lines, the different lines near them.
    """
    if chars_per_edit < 2:
        raise ValueError("a line needs more characters than edits: chars_per_edit is 2 or more")
    docs = sized_for(docs, text, SHUFFLED)
    staging = Staging(docs.sparkSession, until_exit=True)
    lines = _lines(docs, key, text)
    places = staging.write(lines.select("key", "pos", "h", "g"), "places")
    place = F.struct("key", "pos")
    firsts = places.groupBy("h", "g").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n")
    )
    firsts = staging.write(firsts, "firsts")
    near = near_lines(lines, firsts, staging, edits, chars_per_edit)
    earlier = (
        near.join(firsts.select(F.col("h").alias("h2"), F.col("g").alias("g2"), "first"), ["h2", "g2"])
        .groupBy("h", "g")
        .agg(F.min("first").alias("near_first"), F.count("*").alias("links"))
    )
    # Lines that appear once and have no near line need no join back.
    marks = (
        firsts.join(earlier, ["h", "g"], "left")
        .where((F.col("first") < F.col("last")) | F.col("links").isNotNull())
        .select("h", "g", F.least("first", "near_first").alias("keep"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    gone = F.when(place > F.col("keep"), F.col("pos"))
    marked = (
        places.distinct()
        .join(marks, ["h", "g"])
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(gone)).alias("removed"), F.sum("links").alias("n_links"))
    )
    return staging.write(marked.withColumnRenamed("key", key), "removed")


def _with_marks(docs: DataFrame, key: str, text: str, removed: str, links: str, **options) -> DataFrame:
    marks = duplicate_lines(docs, key, text, **options).withColumnsRenamed({"removed": removed, "n_links": links})
    # The marks grow with the documents: both are dealt out by key, at any size.
    return docs.join(marks.hint("merge"), key, "left")


def _kept_text(text: Column, removed: Column) -> Column:
    keep = lambda line, n: ~F.array_contains(removed, n)
    kept = F.array_join(F.filter(F.split(text, "\n", -1), keep), "\n")
    return F.when(F.size(F.coalesce(removed, F.array().cast("array<int>"))) > 0, kept).otherwise(text)


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``key``, text without repeated lines, n_lines, n_removed and n_links of every document."""
    narrow = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("text"))
    wide = _with_marks(narrow, key, "text", "removed", "links", **options)
    return wide.select(
        key,
        _kept_text(F.col("text"), F.col("removed")).alias("text"),
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.coalesce(F.size("removed"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def drop_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n_chars: str | None = "n_chars",
    **options,
) -> DataFrame:
    """``docs``, all columns, without repeated lines and without documents that lose all words.

    ``n_chars``, if there is such a column, follows the new text.
    """
    removed, links = fresh(docs.columns, "__removed"), fresh(docs.columns, "__links")
    wide = _with_marks(docs, key, text, removed, links, **options)
    body = _kept_text(F.col(f"`{text}`"), F.col(removed))
    changed = F.size(F.coalesce(removed, F.array().cast("array<int>"))) > 0
    kept = wide.withColumn(text, body).where(~changed | F.col(f"`{text}`").rlike(WORD_CHAR))
    if n_chars in docs.columns:
        size = F.when(changed, F.length(f"`{text}`")).otherwise(F.col(f"`{n_chars}`"))
        kept = kept.withColumn(n_chars, size.cast(docs.schema[n_chars].dataType))
    return kept.select([F.col(f"`{c}`") for c in docs.columns])
