"""The driver's tables as annotation tables. SQL has the same text for DuckDB, as common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL = """WITH slot AS (SELECT l_orderkey AS tid, l_linenumber AS slot, min(l_partkey) AS pk, min(l_suppkey) AS sk FROM lineitem GROUP BY 1, 2),
exon0 AS (SELECT s.tid, o.o_custkey AS gid, 'chr' || CAST(o.o_custkey % 5 + 1 AS VARCHAR) AS chrom,
  CASE WHEN (o.o_custkey % 2 = 0) <> (s.tid % 17 = 0) THEN '+' ELSE '-' END AS strand,
  10000 + (o.o_custkey // 5) * 4000 + CASE WHEN s.tid % 41 = 0 AND s.slot >= 5 THEN 4000 ELSE 0 END AS base, s.slot, s.pk, s.sk
  FROM slot s JOIN orders o ON s.tid = o.o_orderkey),
exon AS (SELECT tid, gid, chrom, strand, CAST(base + slot * 500 + 20 * (pk % 3) AS BIGINT) AS s, CAST(base + slot * 500 + 150 + 25 * (sk % 3) AS BIGINT) AS e,
  tid % 3 = 0 AS is_ref, 'src' || CAST(tid % 4 AS VARCHAR) AS source FROM exon0),
transcript AS (SELECT tid, min(gid) AS gid, min(chrom) AS chrom, min(strand) AS strand, min(s) AS s, max(e) AS e, count(*) AS n_exons, CAST(sum(e - s + 1) AS BIGINT) AS cdna,
  bool_or(is_ref) AS is_ref, min(source) AS source FROM exon GROUP BY tid),
gene AS (SELECT gid, min(chrom) AS chrom, min(s) AS s, max(e) AS e, count(*) AS n_tx, max(n_exons) AS max_exons, count(CASE WHEN tid % 4 <> 0 THEN 1 END) AS n_coding FROM transcript GROUP BY gid),
intron0 AS (SELECT tid, gid, chrom, strand, is_ref, e + 1 AS s, lead(s) OVER (PARTITION BY tid ORDER BY s) - 1 AS e FROM exon),
intron AS (SELECT * FROM intron0 WHERE e IS NOT NULL),
cds0 AS (SELECT x.tid, x.gid, x.chrom, x.strand, greatest(x.s, t.s + 30 + x.tid % 20) AS s, least(x.e, t.e - 30 - x.tid % 25) AS e FROM exon x JOIN transcript t ON x.tid = t.tid WHERE x.tid % 4 <> 0),
cds AS (SELECT * FROM cds0 WHERE s <= e),
junction AS (SELECT chrom, s, e, CASE WHEN s % 7 = 0 THEN NULL ELSE strand END AS strand, count(*) AS score FROM intron WHERE tid % 5 = 0 GROUP BY 1, 2, 3, 4),
hsp0 AS (SELECT l.l_orderkey AS query, l.l_suppkey AS target, 1 + l.l_partkey % 200 AS qstart, least(1 + l.l_partkey % 200 + 3 * (10 + CAST(l.l_quantity AS BIGINT)), t.cdna) AS qend,
  5 + l.l_suppkey % 10 AS nlog, l.l_extendedprice AS bitscore, t.cdna AS qlen, 500 + l.l_suppkey AS tlen, l.l_linenumber AS n FROM lineitem l JOIN transcript t ON l.l_orderkey = t.tid),
hsp AS (SELECT * FROM hsp0 WHERE qstart < qend)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task takes: with larger tables there are more tasks, not larger ones.
TASK_ROWS = 300_000


def spread(d: DataFrame, rows: int, *keys: str) -> DataFrame:
    """d by keys, in as many parts as `rows` rows ask for; in Spark's own number where that is enough."""
    n = -(-rows // TASK_ROWS)
    return d.repartition(*keys) if n <= int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")) else d.repartition(n, *keys)


def exons(line: DataFrame, o: DataFrame, rows: int) -> DataFrame:
    """Exons of lines and orders, by tid: what is grouped or joined by tid after that needs no other shuffle."""
    slot = spread(line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), rows, "l_orderkey").groupBy(F.col("l_orderkey").alias("tid"), F.col("l_linenumber").alias("slot")).agg(F.min("l_partkey").alias("pk"), F.min("l_suppkey").alias("sk"))
    o = o.select(F.col("o_orderkey").alias("tid"), F.col("o_custkey").alias("gid"))
    base = F.expr("10000 + (gid div 5) * 4000 + CASE WHEN tid % 41 = 0 AND slot >= 5 THEN 4000 ELSE 0 END")
    return slot.join(o, "tid").withColumn("base", base).select(
        "tid", "gid", F.expr("concat('chr', gid % 5 + 1)").alias("chrom"), F.expr("CASE WHEN (gid % 2 = 0) <> (tid % 17 = 0) THEN '+' ELSE '-' END").alias("strand"),
        F.expr("CAST(base + slot * 500 + 20 * (pk % 3) AS BIGINT)").alias("s"), F.expr("CAST(base + slot * 500 + 150 + 25 * (sk % 3) AS BIGINT)").alias("e"),
        (F.col("tid") % 3 == 0).alias("is_ref"), F.expr("concat('src', tid % 4)").alias("source"),
    )


def hsps(spark: SparkSession, sf_dir: str, transcript: DataFrame) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").join(transcript.select(F.col("tid").alias("l_orderkey"), F.col("cdna").alias("qlen")), "l_orderkey")
    h = line.selectExpr("l_orderkey AS query", "l_suppkey AS target", "1 + l_partkey % 200 AS qstart", "least(1 + l_partkey % 200 + 3 * (10 + CAST(l_quantity AS BIGINT)), qlen) AS qend", "5 + l_suppkey % 10 AS nlog", "l_extendedprice AS bitscore", "qlen", "500 + l_suppkey AS tlen", "l_linenumber AS n")
    return h.filter("qstart < qend")


def coding(exon: DataFrame, transcript: DataFrame) -> DataFrame:
    t = transcript.select("tid", F.col("s").alias("ts"), F.col("e").alias("te")).filter("tid % 4 <> 0")
    c = exon.join(t, "tid").selectExpr("tid", "gid", "chrom", "strand", "greatest(s, ts + 30 + tid % 20) AS s", "least(e, te - 30 - tid % 25) AS e")
    return c.filter("s <= e")


def junctions(intron: DataFrame) -> DataFrame:
    return intron.filter("tid % 5 = 0").groupBy("chrom", "s", "e", F.expr("CASE WHEN s % 7 = 0 THEN NULL ELSE strand END").alias("strand")).agg(F.count(F.lit(1)).alias("score"))


class Tables:
    """The projected tables of a folder, each made when asked for, and rows, the number of lines that they are made of."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame | int:
        from splicedf.operators import model

        make = {
            "exon": lambda: exons(*(table(self.spark, self.sf_dir, k) for k in ("lineitem", "orders")), self.rows), "rows": lambda: table(self.spark, self.sf_dir, "lineitem").count(), "transcript": lambda: model.transcript_bounds(self.exon), "gene": lambda: model.gene_bounds(self.transcript), "intron": lambda: model.introns(self.exon),
            "cds": lambda: coding(self.exon, self.transcript), "junction": lambda: junctions(self.intron), "hsp": lambda: hsps(self.spark, self.sf_dir, self.transcript),
        }
        if name not in make:
            raise AttributeError(name)
        self.__dict__[name] = made = make[name]()
        return made

    def spread(self, d: DataFrame, *keys: str) -> DataFrame:
        """d, of about as many rows as there are exons or fewer, by keys."""
        return spread(d, self.rows, *keys)

    def keep(self, name: str) -> None:
        """Write a table to the shared folder, once; what is made of it from here on reads it from there."""
        from splicedf.operators.graph import stored

        if name not in self.__dict__.setdefault("_kept", set()):
            self.__dict__[name] = stored(getattr(self, name))
            self._kept.add(name)
