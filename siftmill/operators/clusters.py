"""Groups of rows about one event: components, ordered clusters, representatives."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import stage, unstage


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """id, component: the smallest id that ``edges`` (a, b) reach; ``nodes`` (id) adds rows without edges.

    Each round links every node to the smallest one it knows, and neighbours among
    themselves to the smallest of them, until nothing changes; a few rounds more for
    twice the length. Rounds are written, so a round never repeats those before it, and
    the round before is deleted.
    """
    links = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    seen = None
    while True:
        ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        outward = ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = outward.groupBy("a").agg(F.min("b").alias("m"))
        inward = outward.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b")))
        before, links = links, stage(inward.where("a != b").distinct(), "links")
        unstage(before)
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
    found = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    if nodes is None:
        return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
    return nodes.select("id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def ordered_clusters(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """id, cluster: as ``class_clusters``, for edges (a, b) between rows."""
    return class_clusters(rows, rows.select("id", F.col("id").alias("cls")), edges.select(F.col("a").alias("x"), F.col("b").alias("y")))


def class_clusters(rows: DataFrame, members: DataFrame, links: DataFrame) -> DataFrame:
    """id, cluster: each row in its order joins the first cluster that has a row it matches and whose first row shares a company.

    ``rows``: id, seq, companies (array), alone (rows that open a cluster and never join one).
    Rows match if they are ``members`` (id, cls) of one class or of classes that ``links``
    (x, y) connect, so rows that are alike are never paired; the rows of a class have the same
    companies. A cluster is named by its first row.

    The rule defines a row's cluster by those of the rows before it, so only one assignment fulfils it
    for all rows. All rows are worked on at once: each round every row takes the earliest cluster that the
    classes it matches had touched before it, as of the round before, where a cluster whose first row has itself
    joined another one stands for that one. What no round changes any more is the assignment.
    Rows whose earlier matches are settled stay settled, so rounds end; a chain of n rows takes some log n.
    """
    order = F.struct("seq", "id")
    names = F.array_sort(F.coalesce("companies", F.array().cast("array<string>")))
    all_rows = rows.select("id", order.alias("o"), names.alias("names"), F.coalesce("alone", F.lit(False)).alias("alone"))
    every = stage(members.distinct().join(all_rows, "id").select("cls", "o", "names", "alone"), "members")
    classes = stage(every.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("first"), F.first("names").alias("names")), "classes")
    across = links.select(F.col("x").alias("k"), F.col("y").alias("near")).unionByName(links.select(F.col("y").alias("k"), F.col("x").alias("near")))
    ways = stage(across.unionByName(classes.where("n > 1").select(F.col("cls").alias("k"), F.col("cls").alias("near"))).distinct().join(classes.select(F.col("cls").alias("k"), F.col("names").alias("mine")), "k"), "ways")
    busy = stage(every.join(ways.select(F.col("k").alias("cls")).distinct(), "cls", "left_semi"), "busy")
    first = busy.join(classes.select("cls", "first"), "cls").groupBy("o").agg(F.min("first").alias("first"), F.first("names").alias("names"), F.first("alone").alias("alone"))
    state = stage(first.select("o", "names", "alone", F.when(F.col("alone"), F.col("o")).otherwise(F.col("first")).alias("f"), F.col("names").alias("fn")), "state")
    while True:
        at = state.select(F.col("o").alias("f"), F.col("f").alias("g"), F.col("fn").alias("gn"))
        now = state.select("o", "f").join(at, "f").select("o", "g", "gn")
        touched = _stairs(busy.join(now, "o").groupBy("cls", "g").agg(F.min("o").alias("touch"), F.first("gn").alias("gn")), "cls", "gn")
        met = touched.join(ways, F.col("cls") == F.col("near")).where((F.size("gn") == 0) | (F.size("mine") == 0) | F.arrays_overlap("gn", "mine"))
        open_to = _stairs(met.groupBy("k", "g").agg(F.min("touch").alias("touch"), F.first("gn").alias("gn")), "k")
        taken = busy.where("NOT alone").join(open_to, (F.col("cls") == F.col("k")) & (F.col("touch") < F.col("o"))).groupBy("o").agg(F.min(F.struct("g", "gn")).alias("t"))
        new = state.join(taken, "o", "left").select("o", "names", "alone", F.coalesce("t.g", "o").alias("f"), F.coalesce("t.gn", "names").alias("fn"), (F.coalesce("t.g", "o") != F.col("f")).alias("moved"))
        before, state = state, stage(new, "state")
        unstage(before)
        if state.where("moved").isEmpty():
            break
    return all_rows.select("id", "o").join(state.select("o", "f"), "o", "left").select("id", F.coalesce("f.id", "id").alias("cluster"))


def _stairs(options: DataFrame, *key: str) -> DataFrame:
    """Of ``options`` (g, touch) of a key those whose g is smaller than that of all with an earlier touch."""
    earlier = Window.partitionBy(*key).orderBy("touch").rowsBetween(Window.unboundedPreceding, -1)
    low = options.withColumn("__low", F.min("g").over(earlier))
    return low.where(F.col("__low").isNull() | (F.col("g") < F.col("__low"))).drop("__low")


def elected(rows: DataFrame, group: str, better: Sequence[Column]) -> DataFrame:
    """``rows`` with representative: of each ``group`` the first row by ``better``."""
    return rows.withColumn("representative", F.row_number().over(Window.partitionBy(group).orderBy(*better)) == 1)


def stars(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """id, head: rows in order; one that no earlier head matches is a head, another one belongs to the first head that matches it.

    ``rows``: id, seq; ``edges`` (a, b), b later, match.
    """
    pairs = stage(edges.select("a", "b").distinct(), "pairs")
    settled, _ = heads(pairs)
    order = rows.select(F.col("id").alias("a"), "seq")
    first = pairs.join(settled.where("is_head").select(F.col("id").alias("a")).unionByName(pairs.select("a").distinct().join(pairs.select(F.col("b").alias("a")), "a", "left_anti")), "a", "left_semi")
    first = first.join(order, "a").groupBy("b").agg(F.min(F.struct("seq", "a")).alias("m"))
    others = settled.where("NOT is_head").select("id").join(first.select(F.col("b").alias("id"), F.col("m.a").alias("head")), "id")
    return rows.select("id").join(others, "id", "left").withColumn("head", F.coalesce("head", "id"))


def heads(pairs: DataFrame) -> tuple[DataFrame, int]:
    """(id, is_head) of every b of ``pairs`` (a, b; a earlier), and the number of rounds it took: b is a head if none of its a is. An a that is no b is a head.

    Every row is the negation of what its earlier neighbours say. Each round puts in what is
    known of these: a row with one neighbour left is its negation, so what refers to it refers
    to that neighbour instead, which halves chains; a row that refers to another one both as it is and
    negated has a head among its neighbours for certain.
    """
    refs = stage(pairs.select("b", "a", F.lit(False).alias("p")), "refs")
    free = stage(pairs.select(F.col("a").alias("id")).distinct().join(pairs.select(F.col("b").alias("id")).distinct(), "id", "left_anti"), "free")
    known = free.select("id", F.lit(True).alias("is_head"), F.lit(None).cast(pairs.schema["a"].dataType).alias("to"), F.lit(None).cast("boolean").alias("turned"))
    done, rounds = [], 0
    while True:
        rounds += 1
        told = refs.join(known.withColumnRenamed("id", "a"), "a", "left")
        each = told.select(
            "b", F.when(F.col("is_head").isNull(), F.coalesce("to", "a")).alias("a"),
            (F.col("p") != F.coalesce("is_head", "turned", F.lit(False))).alias("p"), F.col("is_head").isNotNull().alias("sure"),
        )
        each = each.groupBy("b", "a", "sure").agg(F.max("p").alias("hi"), F.min("p").alias("p"))
        left = stage(each.select("b", "a", "p", F.when(F.col("sure"), F.col("hi")).when(F.col("hi") != F.col("p"), True).alias("truth")), "refs")
        state = left.groupBy("b").agg(F.max("truth").alias("any"), F.count_if(F.col("truth").isNull()).alias("n"), F.min(F.when(F.col("truth").isNull(), F.struct("a", "p"))).alias("one"))
        is_head = F.when(F.coalesce("any", F.lit(False)), False).when(F.col("n") == 0, True)
        state = stage(state.select(F.col("b").alias("id"), is_head.alias("is_head"), F.when(F.col("n") == 1, F.col("one.a")).alias("to"), F.when(F.col("n") == 1, ~F.col("one.p")).alias("turned")), "known")
        done.append(state.where("is_head IS NOT NULL").select("id", "is_head"))
        if state.where("is_head IS NULL").isEmpty():
            return reduce(DataFrame.unionByName, done), rounds
        refs = left.where("truth IS NULL").join(state.where("is_head IS NOT NULL").select(F.col("id").alias("b")), "b", "left_anti").select("b", "a", "p")
        # All that is settled: a row may come to refer to one that was settled rounds ago, through a row in between.
        nothing = (F.lit(None).cast(pairs.schema["a"].dataType).alias("to"), F.lit(None).cast("boolean").alias("turned"))
        settled = reduce(DataFrame.unionByName, [free.withColumn("is_head", F.lit(True)), *done])
        known = settled.select("id", "is_head", *nothing).unionByName(state.where("is_head IS NULL AND to IS NOT NULL"))


def class_stars(rows: DataFrame, by: Sequence[str], links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """id, head: ``stars`` of ``rows`` (id, seq) of which those that are equal in ``by`` match each other.

    Such rows are one class, which comes where its first row does: they all have the head of that row.
    ``links`` takes the classes (id, seq and ``by``; a class has its first row's id) and gives pairs (a, b) that match, in any order.
    """
    classes = rows.groupBy(*by).agg(F.min(F.struct("seq", "id")).alias("first"))
    classes = stage(classes.select(*by, "first.id", "first.seq"), "classes")
    x, y = (classes.select(F.col("id").alias(k), F.col("seq").alias(f"seq_{k}")) for k in "ab")
    met = links(classes).select("a", "b").join(x, "a").join(y, "b")
    first = F.col("seq_a") < F.col("seq_b")
    edges = met.where("a != b").select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("b"))
    found = stars(classes.select("id", "seq"), edges).withColumnRenamed("id", "cls")
    return class_members(rows, classes.withColumnRenamed("id", "cls"), by).join(found, "cls").select("id", "head")


def class_members(rows: DataFrame, classes: DataFrame, by: Sequence[str]) -> DataFrame:
    """id, cls of each of ``rows``, whose class is that with the same ``by``; nulls are equal."""
    keyed = classes.select(*(F.col(c).alias(f"__{c}") for c in by), "cls")
    return rows.join(keyed, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by))).select("id", "cls")
