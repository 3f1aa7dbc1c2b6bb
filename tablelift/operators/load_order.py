"""In which order tables can be loaded so that every foreign key finds its parents.

A table's level is the longest chain of foreign keys below it: level 0 refers to nothing, and all tables of a
level can be loaded at once after those before.  Tables that refer to each other in a circle have no such order:
they are loaded together, and what depends on them comes after.

Names become numbers first.  Levels are found round by round: a round joins the keys with the tables that the last
one has ordered, and counts for each table how many of its keys lead to ordered ones.  What no round reaches has
a circle below it.  Of that only the core - circles, and what lies between them - is searched for circles, by the
smallest number from which a way leads to each table, and back.  No step keeps more rows than there are keys and tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablelift.session import materialize

# Rounds whose results are read as one table from then on.
_ROUNDS_KEPT = 32


def _ends(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, level 0): what edges lead to and none leads on from."""
    last = edges.select(F.col(b).alias("id")).distinct().join(edges.select(F.col(a).alias("id")), "id", "left_anti")
    return last.withColumn("level", F.lit(0))


def _counted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the number of edges of ``a``, written."""
    edges = materialize(edges.select("a", "b"), "load-edges")
    return materialize(edges.join(edges.groupBy("a").agg(F.count("*").alias("need")), "a"), "load-edges")


def _peel(edges: DataFrame, front: DataFrame) -> DataFrame:
    """(id, level) of ``front`` and of all nodes from which every way over ``edges`` (of :func:`_counted`) leads there.

    The level is one more than the largest that an edge leads to.  A node waits until all its edges are counted.
    """
    found, waiting, rounds = front, None, 0
    while True:
        hits = edges.join(front.select(F.col("id").alias("b"), "level"), "b").select("a", F.lit(1).cast("long").alias("got"), "need", "level")
        if waiting is not None:
            hits = hits.unionByName(waiting)
        counts = hits.groupBy("a").agg(F.sum("got").alias("got"), F.max("need").alias("need"), F.max("level").alias("level"))
        counts = materialize(counts, "load-round")
        front = counts.where("got = need").select(F.col("a").alias("id"), (F.col("level") + 1).alias("level"))
        waiting = counts.where("got < need")
        if front.isEmpty():
            return materialize(found, "load-found")
        found, rounds = found.unionByName(front), rounds + 1
        if rounds % _ROUNDS_KEPT == 0:
            found = materialize(found, "load-found")


def _core(edges: DataFrame) -> DataFrame:
    """The edges (a, b) on circles and on ways from one circle to another."""
    for a, b in (("a", "b"), ("b", "a")):
        turned = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
        ends = materialize(_ends(turned), "load-ends")
        if ends.isEmpty():
            continue
        gone = _peel(_counted(turned), ends)
        for end in (a, b):
            edges = edges.join(gone.select(F.col("id").alias(end)), end, "left_anti")
        edges = materialize(edges.select("a", "b"), "load-core")
    return edges


def _sources(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest node from which a way leads to each, which may be itself.

    A round goes over every edge, and from each root to the root of that, so ways are not gone edge by edge.
    """
    nodes = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    roots = materialize(nodes.withColumn("root", F.col("id")), "load-roots")
    while True:
        over = edges.join(roots.select(F.col("id").alias("a"), "root"), "a").select(F.col("b").alias("id"), "root", F.lit(None).cast("long").alias("was"))
        further = roots.select(F.col("id").alias("was"), F.col("root").alias("further"))
        jump = roots.withColumnRenamed("root", "was").join(further, "was").select("id", F.col("further").alias("root"), "was")
        least = over.unionByName(jump).groupBy("id").agg(F.min("root").alias("root"), F.min("was").alias("was"))
        least = materialize(least, "load-roots")
        roots = least.select("id", "root")
        if least.where("root < was").isEmpty():
            return roots


def _circles(edges: DataFrame) -> DataFrame:
    """(id, knot) of all nodes of circles over ``edges`` (a, b); ``knot`` is the smallest node of its circles."""
    found = materialize(edges.select(F.col("a").alias("id"), F.col("a").alias("knot")).where("false"), "load-circles")
    while True:
        edges = _core(edges)
        if edges.isEmpty():
            return found
        # A root's circle is all that it leads to, as the smallest, and that leads back to it among these.
        roots = _sources(edges)
        of = {end: roots.select(F.col("id").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b")}
        inside = edges.join(of["a"], "a").join(of["b"], "b").where("root_a = root_b")
        back = _sources(materialize(inside.select(F.col("b").alias("a"), F.col("a").alias("b")), "load-back"))
        members = materialize(roots.join(back, ["id", "root"]).withColumnRenamed("root", "knot"), "load-members")
        several = members.groupBy("knot").agg(F.count("*").alias("n")).where("n > 1").select("knot")
        found = materialize(found.unionByName(members.join(several, "knot").select("id", "knot")), "load-circles")
        settled = materialize(members.select("id").union(roots.where("id = root").select("id")).distinct(), "load-settled")
        for end in ("a", "b"):
            edges = edges.join(settled.select(F.col("id").alias(end)), end, "left_anti")
        edges = materialize(edges.select("a", "b"), "load-rest")


def load_order(tables: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """(table_name, level, cycle) for every row of ``tables`` (table_name), from ``foreign_keys`` (table_name, ref_table).

    ``cycle`` is the smallest name of the tables that refer to each other in a circle with this one, NULL if there
    is no such circle; a table that refers to itself alone is none.  Tables of a circle have one level.  Keys of
    or to tables that are not in ``tables`` do not count.  A NULL name has no keys, so its level is 0.
    """
    nodes = tables.select("table_name").distinct().withColumn("id", F.monotonically_increasing_id())
    nodes = materialize(nodes, "load-tables")
    edges = foreign_keys.select(F.col("table_name").alias("a"), F.col("ref_table").alias("b")).where("a <> b")
    for end in ("a", "b"):
        edges = edges.join(nodes.select(F.col("table_name").alias(end), F.col("id").alias(f"id_{end}")), end)
    edges = _counted(edges.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct())
    free = nodes.select("id").join(edges.select(F.col("a").alias("id")), "id", "left_anti").withColumn("level", F.lit(0))
    order = _peel(edges, materialize(free, "load-free"))
    stuck = materialize(edges.select("a", "b").join(order.select(F.col("id").alias("a")), "a", "left_anti"), "load-stuck")
    if stuck.isEmpty():
        return nodes.join(order, "id").select("table_name", "level", F.lit(None).cast("string").alias("cycle"))

    circles = _circles(stuck.join(order.select(F.col("id").alias("b")), "b", "left_anti"))
    # Each circle becomes one node, its knot; among these there are no circles, so all the rest is reached.
    for end in ("a", "b"):
        knots = circles.select(F.col("id").alias(end), "knot")
        other = "b" if end == "a" else "a"
        stuck = stuck.join(knots, end, "left").select(other, F.coalesce("knot", end).alias(end))
    up = _counted(stuck.where("a <> b").distinct())
    alone = circles.select(F.col("knot").alias("id")).distinct().join(up.select(F.col("a").alias("id")), "id", "left_anti")
    front = materialize(order.unionByName(alone.withColumn("level", F.lit(0))), "load-free")
    order = _peel(up, front)
    cycles = circles.join(nodes, "id").groupBy("knot").agg(F.min("table_name").alias("cycle"))
    named = nodes.join(circles, "id", "left").select("table_name", F.coalesce("knot", "id").alias("id")).join(order, "id")
    return named.join(cycles.withColumnRenamed("knot", "id"), "id", "left").select("table_name", "level", "cycle")


def levels(order: DataFrame) -> list[list[str]]:
    """The names of :func:`load_order` by level, for a plan's driver loop; one row per table."""
    out: dict[int, list[str]] = {}
    for row in order.orderBy("level", "table_name").collect():
        out.setdefault(row.level, []).append(row.table_name)
    return [out[k] for k in sorted(out)]
