"""Line dedup by a deletion-neighbourhood join. DataFrame functions only.

Lines count from ``MIN_CHARS`` characters on; shorter ones are always kept. A line
goes if an earlier line of the corpus, by (doc_id, line number), equals it or is one
character edit away: judged on the input, not on what is left.

* Equal lines meet by their hash; the first one stays.
* A line and its variants without one character become hashed keys. Lines that
  differ in one character share the variant without it; a line that has one
  character more has the other line itself as a variant. Each member of a bucket is
  paired with the bucket's earliest line only, never with all others, and the edit
  distance of the two texts is verified.
* Only lines and places that can have a partner need variants. Cut by the shorter
  line's length, the edit lies in one piece and both lines agree before and after
  it. So lines first meet by all but one of two pieces; those that do, by all but
  one of the pieces that these are cut into (``PIECES``, twice); and those that do,
  by their variants inside that piece. This loses no pair.

Nothing is broadcast by a hint: sides meet by shuffles unless Spark finds one below
its own threshold. Keys that many rows may share are salted (``SALTS``). Texts are
shuffled twice, by document: to read the lines that need variants, and at the end.

Hashes are pairs of 64-bit hashes under two seeds; the coarse rounds take one.

Cases: a null text has no lines; rows that repeat a doc_id are the same places, so
equal lines at equal places are alike and stay or go together; a null doc_id comes
first; ties between different lines at one place go by their hash; an empty table
gives an empty result; other columns of the input are left alone (``drop_lines``) or
ignored (``removed_lines``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import documents, written

MIN_CHARS, MAX_EDITS, PIECES, SALTS = 20, 1, (2, 4, 16), 8
LEAST = -(2**63)


def _tasks(df: DataFrame) -> int:
    """Tasks for work that is heavier than its bytes say."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _x(*c: Column) -> Column:
    return F.xxhash64(*c)


def _y(*c: Column) -> Column:
    return F.xxhash64(F.lit(1), *c)


def _text_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, t (hash of the text), line_no, line, n of each line that counts."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.withColumn("n", F.char_length("line")).where(F.col("n") >= min_chars)


def _outside(line: Column, n: Column, m: Column, a: Column, b: Column) -> Column:
    """Hash of a line of n characters but for [a, b) of the m that the shorter line has."""
    return F.xxhash64(a, m - b, F.left(line, a), F.right(line, m - b))


def _bound(i: Column, m: Column, pieces: int) -> Column:
    return F.floor(i * m / pieces).cast("int")


def _salt(*c: str) -> Column:
    return F.pmod(F.xxhash64(*c), F.lit(SALTS)).cast("int")


def _salted(df: DataFrame) -> DataFrame:
    """Each row of ``df`` under each salt."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _piece(line: Column, n: Column, d: int, i: int, pieces: int) -> Column:
    """Hash of a line but for piece i: as the shorter line or one of two equally long ones (d = 0), or as the longer one (d = 1)."""
    m = n - d
    return _outside(line, n, m, _bound(F.lit(i), m, pieces), _bound(F.lit(i + 1), m, pieces))


def _shared(keyed: DataFrame) -> DataFrame:
    """Keys that two lines have."""
    return keyed.groupBy("key").agg(F.min("x").alias("a"), F.max("x").alias("b")).where("a != b").select("key")


def removed_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, max_edits: int = MAX_EDITS) -> DataFrame:
    """doc_id, t, line_no, near of each line that goes; ``near`` if no line equal to it is earlier."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    lines = _text_lines(docs, min_chars)
    line, n = F.col("line"), F.col("n")
    # One number for doc_id and line number: it can be aggregated by hashing.
    place = F.coalesce("doc_id", F.lit(LEAST)).cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("line_no").cast("decimal(10,0)")
    keys = F.array_distinct(F.array(*(_piece(line, n, d, i, PIECES[0]) for d in (0, 1) for i in range(PIECES[0])))) if max_edits else F.lit(None).cast("array<bigint>")
    table = written(lines.select("doc_id", "t", "line_no", place.alias("place"), _x(line).alias("x"), _y(line).alias("y"), keys.alias("keys")), "lines")
    first = written(table.groupBy("x", "y").agg(F.min("place").alias("first"), F.min_by("t", "place").alias("t"), F.count(F.lit(1)).alias("size")), "first")
    late = first.where("size > 1").select("x", "y", "first", F.lit(False).alias("near"))
    if max_edits:
        near = written(near_lines(docs, table, first), "near")
        late = late.join(near, ["x", "y"], "left_anti").unionByName(first.join(near, ["x", "y"], "left_semi").select("x", "y", "first", F.lit(True).alias("near")))
    late = _salted(written(late, "late"))
    found = table.select("doc_id", "t", "line_no", "place", "x", "y", _salt("doc_id", "line_no").alias("salt")).join(late, ["x", "y", "salt"]).where("near OR place != first")
    return found.select("doc_id", "t", "line_no", (F.col("place") == F.col("first")).alias("near"))


def candidates_of(docs: DataFrame, table: DataFrame, first: DataFrame) -> DataFrame:
    """x, y, first, line, keys of each line that meets another one by a half: ``keys`` are the halves."""
    halves = table.select("x", _salt("doc_id", "line_no").alias("salt"), F.explode("keys").alias("key"))
    shared = _salted(written(_shared(halves), "halves"))
    met = halves.join(shared, ["key", "salt"], "left_semi").groupBy("x").agg(F.collect_set("key").alias("keys"))
    met = written(first.join(met, "x").select("x", "y", "first", "t", "keys"), "met")
    # The first place of each such line, by document; only texts of these documents are cut again.
    line_no = F.pmod("first", F.lit(2**31).cast("decimal(10,0)"))
    doc_id = ((F.col("first") - line_no) / F.lit(2**31).cast("decimal(10,0)")).cast("decimal(20,0)").cast("long")
    wanted = met.groupBy(doc_id.alias("__id"), F.col("t").alias("__t")).agg(F.collect_set(line_no.cast("int")).alias("nos"))
    same = (F.coalesce("doc_id", F.lit(LEAST)) == F.col("__id")) & (F.xxhash64("text") == F.col("__t"))
    of = docs.select("doc_id", "text").join(wanted.hint("shuffle_hash"), same)
    cut = of.select(F.explode(F.filter(F.split("text", "\n"), lambda x, i: F.array_contains("nos", i))).alias("line")).withColumns({"x": _x(F.col("line")), "y": _y(F.col("line"))})
    lines = cut.groupBy("x", "y").agg(F.first("line").alias("line"))
    return written(met.drop("t").join(lines, ["x", "y"]), "candidates")


def near_lines(docs: DataFrame, table: DataFrame, first: DataFrame) -> DataFrame:
    """x, y of each line one edit away from an earlier one."""
    candidates = candidates_of(docs, table, first)
    tasks = _tasks(docs)
    line, n = F.col("line"), F.char_length("line")
    lines = candidates.select("x", "y", "line")

    def finer(close: DataFrame, has: Column, coarse: int, pieces: int) -> DataFrame:
        """x, y, d, i of the finer pieces but for which two lines agree; ``has`` is the array of flagged coarse pieces, d * coarse + i."""
        ratio = pieces // coarse
        each = [
            F.when(F.array_contains(has, d * coarse + i // ratio), F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), _piece(line, n, d, i, pieces).alias("key")))
            for d in (0, 1)
            for i in range(pieces)
        ]
        keyed = close.repartition(tasks, "x", "y").select("x", "y", F.explode(F.array_compact(F.array(*each))).alias("p")).select("x", "y", "p.d", "p.i", "p.key")
        keyed = written(keyed, f"pieces{pieces}")
        return keyed.withColumn("salt", _salt("x")).join(_salted(_shared(keyed)), ["key", "salt"], "left_semi").select("x", "y", "d", "i")

    flagged = F.filter(
        F.array(*(F.when(F.array_contains("keys", _piece(line, n, d, i, PIECES[0])), F.lit(d * PIECES[0] + i)) for d in (0, 1) for i in range(PIECES[0]))), lambda k: k.isNotNull()
    )
    close = finer(candidates.withColumn("has", flagged), F.col("has"), PIECES[0], PIECES[1])
    again = close.groupBy("x", "y").agg(F.collect_set(F.col("d") * PIECES[1] + F.col("i")).alias("has")).join(lines, ["x", "y"])
    close = finer(again, F.col("has"), PIECES[1], PIECES[2])
    # The places inside a piece: each character of it, and for the longer line one more.
    close = close.join(candidates.select("x", "y", "first", "line"), ["x", "y"]).repartition(tasks, "x", "y", "d", "i")
    m = n - F.col("d")
    begin, end = _bound(F.col("i"), m, PIECES[2]), _bound(F.col("i") + 1, m, PIECES[2]) + F.col("d") - 1
    rest = lambda k: F.concat(F.left(line, k), F.right(line, n - 1 - k))
    # A key with a place holds lines that differ in that character; a key without one holds a line and the lines with one character more.
    key = lambda k: F.when(F.col("d") == 0, F.struct(_x(rest(k), k).alias("kx"), _y(rest(k), k).alias("ky"))).otherwise(F.struct(_x(rest(k)).alias("kx"), _y(rest(k)).alias("ky")))
    variants = close.where(begin <= end).select("x", "y", "first", "d", F.explode(F.transform(F.sequence(begin, end), key)).alias("v"))
    variants = written(variants.select("x", "y", "first", "d", "v.kx", "v.ky"), "variants")
    whole = close.where("d = 0").select("x", "y", "first", F.col("x").alias("kx"), F.col("y").alias("ky")).distinct()

    me = F.struct("first", "x", "y")
    swapped = variants.where("d = 0").drop("d").distinct()
    earliest = swapped.groupBy("kx", "ky").agg(F.min(me).alias("e"), F.count(F.lit(1)).alias("size")).where("size > 1")
    pairs = swapped.join(earliest, ["kx", "ky"]).where("x != e.x OR y != e.y").select("x", "y", F.col("e.x").alias("ox"), F.col("e.y").alias("oy"))
    # The line itself is one; of the longer ones the earliest stands for the rest, and each of them meets the line itself.
    sides = variants.where("d = 1").drop("d").distinct().withColumn("whole", F.lit(False)).unionByName(whole.withColumn("whole", F.lit(True)))
    bucket = sides.groupBy("kx", "ky").agg(F.min(F.when(F.col("whole"), me)).alias("short"), F.min(F.when(~F.col("whole"), me)).alias("long")).where("short IS NOT NULL AND long IS NOT NULL")
    other = F.when(F.col("whole"), F.col("long")).otherwise(F.col("short"))
    grown = sides.join(bucket, ["kx", "ky"]).select("x", "y", other["x"].alias("ox"), other["y"].alias("oy"))

    mine, its = candidates.select("x", "y", F.struct("first", "x", "y", "line").alias("mine")), candidates.select(F.col("x").alias("ox"), F.col("y").alias("oy"), F.struct("first", "x", "y", "line").alias("its"))
    both = pairs.unionByName(grown).distinct().join(mine, ["x", "y"]).join(its, ["ox", "oy"])
    verified = (F.levenshtein("mine.line", "its.line", MAX_EDITS) == MAX_EDITS) & (F.col("its") < F.col("mine"))
    return both.where(verified).select("x", "y").distinct()


def _by_document(gone: DataFrame) -> DataFrame:
    """__id, __t, __gone: of each document the numbers of the lines that go."""
    return gone.groupBy(F.col("doc_id").alias("__id"), F.col("t").alias("__t")).agg(F.collect_set("line_no").alias("__gone"), F.count_if("near").alias("__near"))


def _with_gone(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` with the lines that go; the texts are not sorted, their partner is a table of numbers."""
    return docs.join(_by_document(gone).hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__t")), "left")


def _left(text: Column, gone: Column) -> Column:
    """The text without the lines that go."""
    lines = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.when(gone.isNull(), text).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))


def drop_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, max_edits: int = MAX_EDITS) -> DataFrame:
    """``docs`` without the lines that go; a document that loses its last word goes too. ``n_chars``, if there, follows."""
    joined = _with_gone(docs, removed_lines(docs, min_chars=min_chars, max_edits=max_edits))
    out = joined.withColumn("text", _left(F.col("text"), F.col("__gone")))
    out = out.where(F.col("__gone").isNull() | F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def line_report(docs: DataFrame, *, min_chars: int = MIN_CHARS, max_edits: int = MAX_EDITS) -> DataFrame:
    """doc_id, n_lines, n_removed, n_near, kept_sha256 of each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    return _with_gone(docs, removed_lines(docs, min_chars=min_chars, max_edits=max_edits)).select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("__near", F.lit(0)).cast("long").alias("n_near"),
        F.sha2(F.coalesce(_left(F.col("text"), F.col("__gone")), F.lit("")), 256).alias("kept_sha256"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir))


OP4_SQL = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
long_ones AS (SELECT * FROM lines WHERE length(line) >= {MIN_CHARS}),
firsts AS (SELECT line, min((doc_id, line_no)) AS spot FROM long_ones GROUP BY line),
variants AS (
  SELECT line, spot, i, left(line, i - 1) || substr(line, i + 1) AS rest
  FROM (SELECT line, spot, unnest(range(1, length(line) + 1)) AS i FROM firsts)),
near AS (
  SELECT DISTINCT a.line FROM variants a JOIN variants b ON a.rest = b.rest AND a.i = b.i AND b.spot < a.spot AND a.line <> b.line
  WHERE levenshtein(a.line, b.line) = 1
  UNION SELECT a.line FROM variants a JOIN firsts b ON a.rest = b.line AND b.spot < a.spot
  UNION SELECT b.line FROM variants a JOIN firsts b ON a.rest = b.line AND a.spot < b.spot),
gone AS (
  SELECT l.doc_id, l.line_no, f.spot = (l.doc_id, l.line_no) AS near
  FROM long_ones l JOIN firsts f USING (line)
  WHERE f.spot <> (l.doc_id, l.line_no) OR l.line IN (SELECT line FROM near)),
counts AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (near) AS n_near FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS t
  FROM lines ANTI JOIN gone USING (doc_id, line_no) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_near, 0) AS n_near,
       sha256(coalesce(t, '')) AS kept_sha256
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
