"""Line deduplication: a suffix array over line ids by prefix doubling; later copies of repeated runs are deleted.

Runs (``dedup_lines``, which the query and the pipeline use): the corpus is one sequence of line ids, broken at the ends of
documents. A line may be cut further, into sentences, so that a passage inside a line is found by the whole sentences in
it, at several times the cost; below, a line is such a part. A line that occurs once parts the sequence, and islands with too few words go at once.
Prefix doubling names the runs of 1, 2, 4, ... lines by pairs of names of half the length, over all documents at once;
equal runs get the same name, which is the place of one of them: the suffix array's order up to ties, without the order
of the groups. Runs that occur once leave after each round. Two names that overlap identify a run of any length, so the
suffixes that share a prefix of at least ``min_words`` words, an interval of the suffix array of at
least that common-prefix length, are one group. Its first place stays, the others are deleted.

Of all repeated runs the shortest ones with ``min_words`` words, from each line onwards and
from each line backwards, are looked at. Together they cover every maximal repeated run.

Passages (``dedup_passages``, for callers who want them) are cut to the word. Each window of ``min_words`` words has a seed, the least hash of
the short runs of words in it. Neighbours with one seed are one row. Rows whose seed occurs once have no equal window; the
others are compared.

Everything is a DataFrame expression.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealtide.llm.common import dealt_join, fold, numbered, table

MIN_WORDS = 50
# Places where a sentence ends within a line.
SENTENCE = r"(?<=[.!?][\x20\t]|[。！？])"
_WORD = r"[^\x20\x09-\x0D]+"
_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
# Words of the short runs whose least hash is a seed.
UNIT = 8


def _parts(text: Column, cut: str | None) -> Column:
    """The lines of a text, or what a cut leaves of them: number of the line, part."""

    def of(line: Column, i: Column) -> Column:
        return F.transform(F.split(line, cut) if cut else F.array(line), lambda part: F.struct(i.alias("row"), part.alias("part")))

    return F.flatten(F.transform(F.split(text, "\n"), of))


def _lines(text: Column, cut: str | None) -> Column:
    """The lines with a word: two hashes of what is between outer white space, words."""

    def line(x: Column) -> Column:
        bare = F.trim(x["part"], F.lit(_WHITE))
        return F.struct(F.xxhash64(bare).alias("h"), F.hash(bare).alias("g"), F.regexp_count(bare, F.lit(_WORD)).alias("words"))

    return F.filter(F.transform(_parts(text, cut), line), lambda x: x["words"] > 0)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` reads it in a loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated(places: DataFrame, by: list[str]) -> DataFrame:
    """``places`` whose value of ``by`` occurs more than once, with the first of these places as name_row, name_line instead of ``by``.

    The names are aggregated before the shuffle, and frequent values are dealt out in the join back.
    """
    place = F.struct("_row", "line")
    names = places.groupBy(*by).agg(F.min(place).alias("name"), F.count("*").alias("n")).where("n > 1")
    names = fold(names.select(*by, F.col("name._row").alias("_to"), F.col("name.line").alias("_at"), "n"), "names")
    found = dealt_join(places, names, by, F.xxhash64("_row", "line"), "n", None)
    return found.drop(*by, "n").withColumnsRenamed({"_to": "name_row", "_at": "name_line"})


def islands(lines: DataFrame, least: int) -> DataFrame:
    """(_key, _row, line, name_row, name_line, ahead, behind): repeated lines in stretches of ``least`` words or more of such lines.

    ahead and behind: how many lines onwards and backwards hold ``least`` words; null if there are too few.
    """
    text = Window.partitionBy("_row").orderBy("line")
    apart = repeated(lines, ["h", "g"]).withColumn("island", F.col("line") - F.row_number().over(text))
    island = Window.partitionBy("_row", "island")
    until = F.sum("words").over(island.orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    found = apart.withColumn("until", until).withColumn("first", F.col("until") - F.col("words"))
    found = found.withColumn("total", F.max("until").over(island)).where(F.col("total") >= least)
    ahead = F.count("*").over(island.orderBy("first").rangeBetween(0, least - 1))
    behind = F.count("*").over(island.orderBy("until").rangeBetween(1 - least, 0))
    return found.select(
        "_key",
        "_row",
        "line",
        "name_row",
        "name_line",
        F.when(F.col("first") + least <= F.col("total"), ahead).cast("int").alias("ahead"),
        F.when(F.col("until") >= least, behind).cast("int").alias("behind"),
    )


def doubled(lines: DataFrame, longest: int) -> DataFrame:
    """(level, _row, line, name_row, name_line): names of the repeated runs of 2^level lines, up to ``longest`` lines."""
    names = lines.select("_row", "line", "name_row", "name_line")
    levels, level = [names.withColumn("level", F.lit(0))], 0
    while 2 ** (level + 1) <= longest:
        step = 2**level
        here = Window.partitionBy("_row").orderBy("line").rangeBetween(step, step)
        pairs = names.withColumn("next", F.first(F.struct("name_row", "name_line")).over(here)).where("next IS NOT NULL")
        pairs = pairs.select(
            "_row",
            "line",
            F.col("name_row").alias("this_row"),
            F.col("name_line").alias("this_line"),
            F.col("next.name_row").alias("next_row"),
            F.col("next.name_line").alias("next_line"),
        )
        names = fold(repeated(fold(pairs, "pairs"), ["this_row", "this_line", "next_row", "next_line"]), "runs")
        level += 1
        levels.append(names.withColumn("level", F.lit(level)))
    return reduce(DataFrame.unionByName, levels)


def later_copies(documents: DataFrame, key: str, least: int, cut: str | None) -> DataFrame:
    """(_row, deleted): the numbers, among the lines with a word, of the lines to delete.

    ``documents`` has the columns key, text and _row, a number of the row.
    """
    lines = documents.select(F.col(key).alias("_key"), "_row", F.posexplode(_lines(F.col("text"), cut)).alias("line", "x"))
    lines = fold(lines.select("_key", "_row", "line", "x.*"), "lines")
    apart = fold(islands(lines, least), "islands")
    longest = apart.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    names = doubled(apart, longest)
    onwards = apart.where("ahead IS NOT NULL").select("_key", "_row", F.col("line").alias("first"), F.col("ahead").alias("size"))
    backwards = apart.where("behind IS NOT NULL").select("_key", "_row", (F.col("line") - F.col("behind") + 1).alias("first"), F.col("behind").alias("size"))
    level = F.floor(F.log2("size")).cast("int")
    runs = onwards.union(backwards).distinct().withColumn("level", level)
    runs = runs.withColumn("last", (F.col("first") + F.col("size") - F.expr("shiftleft(1, level)")).cast("int"))
    head = names.select("level", "_row", F.col("line").alias("first"), F.struct("name_row", "name_line").alias("head"))
    tail = names.select("level", "_row", F.col("line").alias("last"), F.struct("name_row", "name_line").alias("tail"))
    known = runs.join(head, ["level", "_row", "first"]).join(tail, ["level", "_row", "last"]).select("_key", "_row", "first", "size", "head", "tail")
    known = fold(known, "known")
    group = ["size", "head", "tail"]
    place = F.struct("_key", "_row", "first")
    kept = known.groupBy(*group).agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1")
    later = (F.col("kept._row") != F.col("_row")) | (F.col("kept.first") + F.col("size") <= F.col("first"))
    copies = dealt_join(known, fold(kept, "kept"), group, F.xxhash64("_row", "first"), "n", None).where(later)
    gone = copies.select("_row", F.explode(F.sequence("first", F.col("first") + F.col("size") - 1)).alias("line"))
    # a text has as many entries as lines
    return gone.groupBy("_row").agg(F.collect_set("line").alias("deleted"))


def _without(parts: Column, deleted: Column) -> Column:
    """The text without the parts whose numbers, among those with a word, are in ``deleted``. Lines that lose all parts go."""
    numbers = F.transform(parts, lambda x, i: F.when(F.rlike(x["part"], F.lit(_WORD)), i))
    worded = F.filter(numbers, lambda i: i.isNotNull())
    gone = _bound(worded, lambda raw: F.transform(deleted, lambda i: F.element_at(raw, i + 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)

    def joined(left: Column) -> Column:
        def tidy(n: Column, k: Column) -> Column:
            here, row = F.get(parts, n)["part"], F.get(parts, n)["row"]
            parted = (k > 0) & (F.get(parts, F.get(left, k - 1))["row"] != row)
            # the last part that is left of a line whose end went
            ends = (F.get(parts, n + 1)["row"] == row) & ~F.coalesce(F.get(parts, F.get(left, k + 1))["row"] == row, F.lit(False))
            return F.concat(F.when(parted, "\n").otherwise(""), F.when(ends, F.rtrim(here, F.lit(_WHITE))).otherwise(here))

        return F.array_join(F.transform(left, tidy), "")

    return _bound(left, joined)


def dedup_lines(documents: DataFrame, key: str = "doc_id", min_words: int = MIN_WORDS, cut: str | None = None) -> DataFrame:
    """``documents`` without later copies of repeated runs of lines, with n_lines and n_deleted.

    A line is deleted if it lies in a run of whole lines of one document, with ``min_words``
    words or more, that also occurs before: in a row with a smaller key (then in table order), or
    earlier in the text without overlap. Lines are compared without the white space around them. ``cut``, a pattern of the
    places where a line is parted further (``SENTENCE``), makes these parts the lines that are compared, deleted and counted in n_deleted;
    n_lines counts lines as they are. Lines without a word stay and part no run. A text
    whose lines all go becomes empty; null and empty texts stay as they are with 0 lines. Very long texts are read whole. Null
    keys count as smallest; repeated rows are copies of each other. Input columns n_lines and
    n_deleted are replaced, all others stay, whatever their names. An empty table stays empty. Rows are numbered and written once, so
    ``documents`` may be split otherwise when it is read again; equal keys are ordered by these numbers.
    """
    columns = [c for c in documents.columns if c not in ("n_lines", "n_deleted")]
    rows = numbered(documents.select(*columns), key)
    marks = later_copies(rows.select("_key", "text", "_row"), "_key", min_words, cut)
    joined = rows.select("_doc", "_row").join(marks, "_row", "left").select("_doc", "deleted", F.col("_doc.text").alias("text"))
    size = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    text = _bound(_parts(F.col("text"), cut), lambda parts: _without(parts, F.col("deleted")))
    n_deleted = F.coalesce(F.size("deleted"), F.lit(0))
    changed = {"text": F.when(F.col("deleted").isNull(), F.col("text")).otherwise(text)}
    counted = F.when(F.coalesce(F.length("text"), F.lit(0)) > 0, size).otherwise(0)
    return joined.select(
        *[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in columns], counted.cast("long").alias("n_lines"), n_deleted.cast("long").alias("n_deleted")
    )


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def _lesser(values: Column, shift: int) -> Column:
    """Each value or, if it is less, the one ``shift`` places further on."""
    return _bound(values, lambda v: F.transform(v, lambda x, i: F.least(x, F.get(v, i + shift))))


def _least_ahead(values: Column, width: int) -> Column:
    """The least of each ``width`` values in a row, by doubling."""
    least, step = values, 1
    shifts = []
    while 2 * step <= width:
        shifts.append(step)
        step *= 2
    for shift in [*shifts, width - step]:
        least = _lesser(least, shift)
    return _bound(least, lambda v: F.slice(v, 1, F.size(v) - width + 1))


def _seeded(words: Column, least: int) -> Column:
    """The windows of ``least`` words as runs of neighbours with one seed: first, size, seed and two hashes of all words of the run.

    The seed of a window is the least hash of the short runs of words in it, so equal windows have equal seeds.
    """
    unit = max(1, min(UNIT, least // 2))

    def runs(words: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(words) - unit + 1), lambda i: F.xxhash64(F.slice(words, i, F.lit(unit))))

        def by_seed(seeds: Column) -> Column:
            begins = F.filter(F.sequence(F.lit(0), F.size(seeds) - 1), lambda i: (i == 0) | (F.get(seeds, i) != F.get(seeds, i - 1)))

            def run(begins: Column, first: Column, j: Column) -> Column:
                size = F.coalesce(F.get(begins, j + 1), F.size(seeds)) - first
                part = F.slice(words, first + 1, size + least - 1)
                return F.struct(first.alias("first"), size.alias("size"), F.get(seeds, first).alias("seed"), F.xxhash64(part).alias("h"), F.hash(part).alias("g"))

            return _bound(begins, lambda begins: F.transform(begins, lambda first, j: run(begins, first, j)))

        return _bound(_least_ahead(grams, least - unit + 1), by_seed)

    return _bound(words, lambda words: F.when(F.size(words) >= least, runs(words)))


def repeated_words_of(documents: DataFrame, key: str, least: int) -> DataFrame:
    """(_row, cuts): the words to delete, as disjoint ranges (first, until) in order.

    Runs of windows that are equal as a whole are compared by their hashes; only runs that share a
    seed and differ, as at the ends of a passage, are compared window by window.
    """
    runs = documents.select(F.col(key).alias("_key"), "_row", F.explode(_seeded(_words(F.col("text")), least)).alias("x"))
    runs = fold(runs.select("_key", "_row", "x.*"), "seeds")
    # a run longer than a window may repeat itself without overlap
    often = runs.groupBy("seed").agg(F.sum(F.when(F.col("size") > least, 2).otherwise(1)).alias("n")).where("n > 1").drop("n")
    known = fold(runs.join(often, "seed"), "known")
    place = F.struct("_key", "_row", "first")
    kept = known.groupBy("seed", "size", "h", "g").agg(F.min(place).alias("kept"))
    later = (F.col("kept._row") != F.col("_row")) | (F.col("kept.first") + least <= F.col("first"))
    known = fold(known.join(kept, ["seed", "size", "h", "g"]).withColumn("later", later), "compared")
    whole = known.where("later").select("_row", "first", (F.col("first") + F.col("size") + least - 1).alias("until"))

    rest = known.where("NOT later")
    mixed = rest.groupBy("seed").agg(F.sum(F.when(F.col("size") > least, 2).otherwise(1)).alias("n")).where("n > 1").drop("n")
    # a text has as many entries as runs
    spans = rest.join(mixed, "seed").groupBy("_row").agg(F.collect_list(F.struct("first", "size")).alias("spans"))

    def windows(words: Column) -> Column:
        def window(at: Column) -> Column:
            part = F.slice(words, at + 1, F.lit(least))
            return F.struct(at.alias("first"), F.xxhash64(part).alias("h"), F.hash(part).alias("g"))

        return F.flatten(F.transform("spans", lambda s: F.transform(F.sequence(s["first"], s["first"] + s["size"] - 1), window)))

    single = documents.join(spans, "_row").select(F.col(key).alias("_key"), "_row", F.explode(_bound(_words(F.col("text")), windows)).alias("x"))
    single = fold(single.select("_key", "_row", "x.*"), "windows")
    kept = single.groupBy("h", "g").agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = single.join(kept, ["h", "g"]).where(later).select("_row", "first", (F.col("first") + least).alias("until"))

    before = Window.partitionBy("_row").orderBy("first", "until").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("_row").orderBy("first", "until").rowsBetween(Window.unboundedPreceding, 0)
    gone = whole.union(copies).withColumn("apart", F.coalesce((F.col("first") > F.max("until").over(before)).cast("int"), F.lit(0)))
    gone = gone.withColumn("part", F.sum("apart").over(so_far))
    ranges = gone.groupBy("_row", "part").agg(F.min("first").alias("first"), F.max("until").alias("until"))
    return ranges.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("first", "until"))).alias("cuts"))


def _cut(text: Column, cuts: Column) -> Column:
    """The text without the words in ``cuts``, nor the white space before them. What is left of two lines stays on two lines."""
    body = F.rtrim(text, F.lit(_WHITE))
    pieces = F.regexp_extract_all(body, F.lit(rf"[\x20\x09-\x0D]*{_WORD}"), F.lit(0))

    def left(pieces: Column) -> Column:
        def joined(first: Column, until: Column) -> Column:
            return F.array_join(F.slice(pieces, first + 1, until - first), "")

        def behind(cut: Column, j: Column) -> Column:
            until = F.coalesce(F.get(cuts, j + 1)["first"], F.size(pieces))

            def tidy(piece: Column) -> Column:
                bare = F.ltrim(piece, F.lit(_WHITE))
                lead = F.substr(piece, F.lit(1), F.length(piece) - F.length(bare))
                begin = F.when(F.instr(lead, "\n") > 0, F.substr(piece, F.instr(lead, "\n") + 1)).otherwise(bare)
                parted = (F.instr(lead, "\n") == 0) & (F.instr(joined(cut["first"], cut["until"]), "\n") > 0)
                return F.when(piece == "", "").when(cut["first"] == 0, begin).when(parted, F.concat(F.lit("\n"), bare)).otherwise(piece)

            return _bound(joined(cut["until"], until), tidy)

        return F.concat(joined(F.lit(0), F.get(cuts, F.lit(0))["first"]), F.array_join(F.transform(cuts, behind), ""))

    rest = _bound(pieces, left)
    return _bound(rest, lambda rest: F.when(rest == "", "").otherwise(F.concat(rest, F.substr(text, F.length(body) + 1))))


def dedup_passages(documents: DataFrame, key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` without later copies of repeated passages, with n_lines and n_deleted, the lines before and those fewer after.

    A word is deleted if it lies in a run of ``min_words`` words of one document that also occurs before: in a row with a
    smaller key (then in table order), or earlier in the text without overlap. Runs begin and end anywhere in a line; only
    words are compared, not the white space between them. A text whose words all go becomes empty; other texts stay as
    they are, null and empty ones with 0 lines. Very long texts are
    read whole. Keys, repeated rows, replaced columns and the numbers are as in ``dedup_lines``.
    """
    columns = [c for c in documents.columns if c not in ("n_lines", "n_deleted")]
    rows = numbered(documents.select(*columns), key)
    marks = repeated_words_of(rows.select("_key", "text", "_row"), "_key", min_words)
    text = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(_cut(F.col("text"), F.col("cuts")))

    def lines(value: Column) -> Column:
        return F.when(F.coalesce(F.length(value), F.lit(0)) > 0, F.length(value) - F.length(F.replace(value, F.lit("\n"), F.lit(""))) + 1).otherwise(0)

    # the text goes through the shuffle once, inside its row
    joined = rows.select("_doc", "_row").join(marks, "_row", "left").select("_doc", "cuts", F.col("_doc.text").alias("text"))
    joined = joined.select("_doc", F.struct(lines(F.col("text")).alias("before"), text.alias("text")).alias("_cut"))
    changed = {"text": F.col("_cut.text")}
    before = F.col("_cut.before").cast("long")
    return joined.select(
        *[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in columns], before.alias("n_lines"), (before - lines(F.col("_cut.text"))).cast("long").alias("n_deleted")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
