"""N-gram Jaccard join over groups of similar texts: a token-group matrix bounds what a group can share with a query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.llm import shingle_sets
from splicedf.llm.common import Scratch, maybe_broadcast, renamed, written
from splicedf.llm.components import components

#: Members of a group of the matrix.
GROUP_SIZE = 64
#: Rows (two longs each) of shared signatures that may be broadcast.
SHARED_ROWS = 500_000
#: Rounds in which classes go that share too few signatures.
PEELS = 1


def text_sets(docs: DataFrame, work: Scratch, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """Written: (_id, th, n, cls, need0, need1, sigs); th is the hash of the text, cls of the whole set, 0 for an empty one."""
    d = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    return work.written(d.mapInArrow(shingle_sets.sets_of(k, num, den), "_id long, th long, n long, cls long, need0 int, need1 int, sigs array<long>"), "sets")


def shared_signatures(sets: DataFrame, classes: DataFrame, work: Scratch) -> DataFrame:
    """Written: (sig, cls, need) of the signatures that more than one class has.

    Copies of a text are one class, and only its first document signs. A signature's classes are summed up before the
    shuffle; those of a signature that just two classes share are the ends of that sum, others are joined back.
    """
    copies = classes.filter("copies > 1").select("cls", "rep", "rep_th")
    own = sets.filter("n > 0").join(maybe_broadcast(copies), "cls", "left").filter(F.col("rep_th").isNull() | F.col("_id").eqNullSafe(F.col("rep")) & (F.col("th") == F.col("rep_th")))
    rows = own.select("cls", F.explode_outer("sigs").alias("sig")).filter("sig IS NOT NULL")
    shared = work.written(rows.groupBy("sig").agg(F.min("cls").alias("a"), F.max("cls").alias("b"), F.count(F.lit(1)).alias("c")).filter("a < b"), "shared")
    more = maybe_broadcast(shared.filter("c > 2").select("sig"), SHARED_ROWS)
    pairs = shared.filter("c = 2")
    ends = pairs.select("sig", F.col("b").alias("cls")).unionAll(pairs.select("sig", F.col("a").alias("cls")))
    needs = classes.select("cls", "need0", "need1")
    m = ends.unionAll(rows.join(more, "sig").select("sig", "cls")).distinct().join(needs, "cls")
    return work.written(m.select("sig", "cls", F.when(F.col("sig").bitwiseAND(F.lit(1)) == 1, F.col("need1")).otherwise(F.col("need0")).alias("need")), "members")


def peeled(members: DataFrame, work: Scratch) -> DataFrame:
    """Written: members (sig, cls, need) without classes that share too few signatures to be similar to any other.

    Two similar classes share at least the lesser of their needs in one space. So a class goes from a space if it has
    fewer signatures there than its own need and than that of every class that it shares one with.
    """
    for _ in range(PEELS):
        low = members.groupBy("sig").agg(F.min("need").alias("low"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("sig", "low")
        m = work.written(members.join(low, "sig"), "peel")
        few = m.groupBy("cls", F.col("sig").bitwiseAND(F.lit(1)).alias("space")).agg(F.count(F.lit(1)).alias("c"), F.min("low").alias("low")).filter("c >= low").select("cls", "space")
        members = work.written(m.join(few, (m["cls"] == few["cls"]) & (m["sig"].bitwiseAND(F.lit(1)) == few["space"]), "left_semi").select("sig", "cls", "need"), "members")
        work.drop("peel")
        work.drop("members", keep=1)
    return members


def labelled(rows: DataFrame, comps: DataFrame, key: str = "cls") -> DataFrame:
    """rows with comp: the component of key, itself if it has none."""
    c = comps.select(F.col("node").alias(key), "comp")
    return rows.join(maybe_broadcast(c), key, "left").withColumn("comp", F.coalesce("comp", F.col(key)))


def open_members(members: DataFrame, comps: DataFrame, work: Scratch) -> DataFrame:
    """Written: (sig, cls, comp, c) of the signatures whose classes are of several components, one of those with the same classes."""
    m = labelled(members.select("sig", "cls", "need"), comps)
    sums = m.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum(F.shiftright(F.xxhash64("cls"), 20)).alias("s"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("x"), F.count(F.lit(1)).alias("c"))
    one = work.written(sums.filter("lo < hi").groupBy("s", "x", "c").agg(F.min("sig").alias("sig"), F.count(F.lit(1)).alias("like")).select("sig", "c", "like"), "open-sigs")
    return work.written(m.join(maybe_broadcast(one, SHARED_ROWS), "sig"), "open-members")


def centres(open_: DataFrame) -> DataFrame:
    """(a, b): each class b with the class a, of another component, that is most central among those it shares a signature with.

    Central is what shares most: a text from which many were made shares more with each than they share with each other.
    """
    weight = open_.groupBy("cls").agg(F.sum((F.col("c") - 1) * F.col("like")).alias("weight"))
    w = open_.join(weight, "cls").withColumn("rank", F.struct("weight", "cls", "comp"))
    top = w.groupBy("sig").agg(F.max("rank").alias("top"))
    return w.join(top, "sig").filter("top.comp <> comp").groupBy(F.col("cls").alias("b")).agg(F.max("top").alias("t")).select(F.col("t.cls").alias("a"), "b")


def star_links(pairs: DataFrame, texts: DataFrame, work: Scratch, k: int, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) that are similar; one pair for each b."""
    p = pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    found = p.select("a", "b", "text_a", "text_b").mapInArrow(shingle_sets.overlaps(k), "a long, b long, common long, total long")
    return work.written(found.filter(F.col("common") * den >= F.col("total") * num).select("a", "b"), "star-links")


def with_links(comps: DataFrame, links: DataFrame, work: Scratch) -> DataFrame:
    """Components of what comps (node, comp) and the links (a, b) of its nodes join."""
    for end in "ab":
        links = labelled(links, comps, end).drop(end).withColumnRenamed("comp", end)
    return components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionAll(links.select("a", "b").distinct()), work)


def matrix_links(open_: DataFrame, first: DataFrame, texts: DataFrame, work: Scratch, k: int, num: int, den: int) -> DataFrame:
    """Links between different components, at least one for each two components that have any.

    The classes of open signatures form clusters, by component where that is large, else by the class that they were
    compared with first. Two clusters meet if between different components they share as many signatures as their least
    demanding members need; each of their groups of about GROUP_SIZE classes then meets each of the other's once, unless
    both are of one and the same component. What is joined is clusters and groups, never pairs of documents.
    """
    nodes = open_.select("cls", "comp").distinct().join(first.select(F.col("b").alias("cls"), "a"), "cls", "left")
    large = nodes.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= GROUP_SIZE // 2).select("comp", "n")
    nodes = nodes.join(maybe_broadcast(large), "comp", "left").withColumn("f", F.when(F.col("n").isNotNull(), F.xxhash64("comp", F.lit(1))).otherwise(F.coalesce("a", "cls")))
    nodes = work.written(nodes.select("cls", "comp", "f"), "group-nodes")
    space = F.col("sig").bitwiseAND(F.lit(1)).alias("space")
    by_sig = work.written(open_.select("sig", "cls", "need", "like").join(nodes, "cls").groupBy("sig", "f").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("need").alias("need"), F.min("like").alias("like")), "cluster-sigs")
    other = by_sig.select("sig", F.col("f").alias("f2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("need").alias("need2"))
    met = by_sig.join(other, "sig").filter("f <= f2 AND least(lo, lo2) < greatest(hi, hi2)").groupBy("f", "f2", space)
    met = work.written(met.agg(F.sum("like").alias("shared"), F.min(F.least("need", "need2")).alias("need")).filter("shared >= need").select("f", "f2").distinct(), "met-clusters")
    sizes = nodes.groupBy("f").agg(F.ceil(F.count(F.lit(1)) / GROUP_SIZE).cast("long").alias("k"))
    nodes = work.written(nodes.join(maybe_broadcast(sizes), "f").select("f", "cls", "comp", F.xxhash64("f", F.pmod(F.xxhash64("cls"), F.col("k"))).alias("g")), "group-members")
    of = work.written(nodes.groupBy("f", "g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")), "groups-of")
    met = met.join(of, "f").join(of.select(F.col("f").alias("f2"), F.col("g").alias("h"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2")), "f2")
    met = met.filter("(f < f2 OR g <= h) AND least(lo, lo2) < greatest(hi, hi2)").select("g", "h")
    groups = work.written(nodes.select("g", "cls", "comp").join(texts, "cls").groupBy("g").agg(F.collect_list(F.struct("cls", "comp", "text")).alias("docs")), "groups")
    both = met.join(groups.select("g", F.col("docs").alias("q")), "g").join(groups.select(F.col("g").alias("h"), F.col("docs").alias("d")), "h")
    return work.written(both.select("h", "q", "d").mapInArrow(shingle_sets.opened(k, num, den), "a long, b long"), "matrix-links")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id_col, n_shingles, component_id (the smallest id reachable over links).

    Two documents link if the Jaccard similarity of their sets of k-word shingles is at least num / den; a text of fewer
    words is one shingle. Null, empty and white texts have empty sets, link with nothing and are their own component.
    Equal sets are one class from the start. Every two similar classes share a signature (see shingle_sets). Each class
    is compared with the most central one that it shares a signature with, so that most of a large group is one component
    at once; then the token-group matrix finds every link that joins components further. Repeated rows link with each
    other; a null id takes the smallest id of its component, if any.
    """
    work = Scratch(docs.sparkSession)
    sets = text_sets(docs, work, k, num, den, id_col, text_col)
    classes = work.written(sets.filter("n > 0").groupBy("cls").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "th")).alias("r"), F.count(F.lit(1)).alias("copies"), F.min("need0").alias("need0"), F.min("need1").alias("need1")).select("cls", "copies", "need0", "need1", F.col("r._id").alias("rep"), F.col("r.th").alias("rep_th")), "classes")
    members = peeled(shared_signatures(sets, classes, work), work)
    of = work.written(sets.select("_id", "n", "cls"), "classes-of")
    work.drop("sets", "shared")
    nodes = members.select("cls").distinct().join(classes, "cls").select("cls", "rep", "rep_th")
    nodes = work.written(nodes, "nodes")
    d = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    texts = work.written(d.join(maybe_broadcast(nodes), F.col("_id").eqNullSafe(F.col("rep")) & (F.col("th") == F.col("rep_th"))).select("cls", "text").dropDuplicates(["cls"]), "texts")
    comps = nodes.select(F.col("cls").alias("node"), F.col("cls").alias("comp"))
    first = work.written(centres(open_members(members, comps, work)), "first")
    comps = with_links(comps, star_links(first, texts, work, k, num, den), work)
    work.drop("open-members", "open-sigs")
    open_ = open_members(members, comps, work)
    comps = with_links(comps, matrix_links(open_, first, texts, work, k, num, den), work)
    named = classes.join(comps, F.col("cls") == F.col("node")).select("cls", "rep", "comp")
    low = named.groupBy("comp").agg(F.min("rep").alias("component"))
    named = work.written(named.join(low, "comp").select("cls", "rep", "component").unionAll(classes.join(comps, F.col("cls") == F.col("node"), "left_anti").filter("copies > 1").select("cls", "rep", F.col("rep").alias("component"))), "named")
    work.drop(*(name for name in work.paths if name not in ("classes-of", "named")))
    out = of.join(maybe_broadcast(named), "cls", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "_id")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with one document of each component: the one with the smallest id. Documents without id, and rows that repeat
    that id, stay; columns pass through, whatever their names. The ids that go are broadcast if checked to be few."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **how)
    gone = maybe_broadcast(written(found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone")).distinct(), "gone"))
    d, cols = renamed(docs)
    return d.join(gone, F.col(f"c{cols.index(id_col)}") == F.col("gone"), "left_anti").toDF(*cols)
