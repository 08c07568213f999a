"""Reports: levels of agreement, all features in one table, pivots, importance of metrics."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import compare, evaluate, evidence, graph, intervals, model
from splicedf.operators.graph import _cut, stored
from splicedf.plans.comparison import HELD, pair_sql, sides
from splicedf.plans.evaluation import COUNTS, EXTERNAL, RATES, flags, union_of
from splicedf.plans.models import CHAIN, SITE
from splicedf.plans.registry import query
from splicedf.sources import formats

def compared(t) -> DataFrame:
    """The pairs of the comparison, written once."""
    return stored(compare.compared(*sides(t)).select("tid_a", "tid_b", "strand_a", "strand_b", "j_f1", "n_f1", "ccode"))


def single(t, pairs: DataFrame) -> DataFrame:
    """The exons of unspliced reference models that an unspliced prediction matches on their strand."""
    own = pairs.filter((F.col("ccode") == "_") & F.col("strand_a").eqNullSafe(F.col("strand_b"))).select(F.col("tid_b").alias("tid")).distinct()
    return t.exon.join(own, "tid", "left_semi").select("chrom", "strand", "s", "e")


def facts(t) -> DataFrame:
    """All facts of the report: a row a level, each over features of its own. Models are written once, as rows with their
    exons, so no level brings the exons of a model together again; exons and introns are written once each, and what their
    bases and splice sites are asked is asked of them."""
    m = stored(model.model_rows(t.exon))
    pairs = stored(compare.compared((m.filter("NOT is_ref"),), (m.filter("is_ref"),)).select("tid_a", "tid_b", "strand_a", "strand_b", "j_f1", "n_f1", "ccode"))
    once = lambda d, k: d.select(F.lit(k).alias("key"), F.col("common").alias("common_ref"), F.col("common").alias("common_pred"), "pred", "ref")
    both = lambda d, k: evaluate.both_confusions(d).select(F.when(F.col("weighted"), k).otherwise(f"{k}_nr").alias("key"), "common_ref", "common_pred", "pred", "ref")
    place = ["chrom", "strand", "s", "e"]
    own = m.select("chrom", "strand", "is_ref", F.col("n_exons").alias("_k"), F.posexplode("xs").alias("_i", "x")).select("chrom", "strand", "is_ref", "_k", (F.col("_i") + 1).alias("_i"), "x.s", "x.e")
    outer = (F.col("_i") == 1) | (F.col("_i") == F.col("_k"))
    exon = stored(own.groupBy(*place).agg(F.bool_or("is_ref").alias("in_ref"), F.bool_or(~F.col("is_ref")).alias("in_pred"), F.bool_or(~outer).alias("inner")))
    intron = stored(evaluate.feature_flags(m.select("chrom", "strand", "is_ref", F.inline(model.gaps())), place))
    chain = evaluate.feature_flags(m.filter("n_exons > 1").select("chrom", "strand", "is_ref", F.xxhash64(model.gaps()).alias("chain")), ["chrom", "strand", "chain"])
    donor = F.coalesce(F.col("first") == (F.col("strand") == "+"), F.lit(False)).alias("donor")
    ends = F.array(F.struct(F.col("s").alias("pos"), F.lit(True).alias("first")), F.struct(F.col("e").alias("pos"), F.lit(False).alias("first")))
    flags = lambda d, *keys: d.groupBy(*keys).agg(*[F.bool_or(c).alias(c) for c in ("in_ref", "in_pred")])
    site = flags(intron.select("chrom", "strand", "in_ref", "in_pred", F.inline(ends)), "chrom", "strand", "pos", donor)
    rows = [
        once(evaluate.base_level(intervals.covered_by(exon, "in_ref", "in_pred", ("chrom", "strand"))), "base"), once(evaluate.flags_confusion(exon), "exon"), once(evaluate.flags_confusion(evaluate.numbered_flags(own.filter(outer & (F.col("_k") > 1)), lone(m, pairs), exon)), "exon_lenient"),
        once(evaluate.flags_confusion(site), "splice"), both(intron, "intron"), both(chain, "chain"), evaluate.found_levels(m, pairs),
    ]
    return _cut(reduce(DataFrame.unionAll, rows))


def lone(m: DataFrame, pairs: DataFrame) -> DataFrame:
    """single() of model_rows: only models of one exon have that code."""
    own = pairs.filter((F.col("ccode") == "_") & F.col("strand_a").eqNullSafe(F.col("strand_b"))).select(F.col("tid_b").alias("tid")).distinct()
    return m.filter("n_exons = 1").join(own, "tid", "left_semi").select("chrom", "strand", "s", "e")


PAIRS = re.sub(r"\bsite\b", "own_site", pair_sql(0, held=HELD.replace(" WHERE mode <> 'many' OR sa = strand)", ")")))
LENIENT = """ix AS (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY s) AS i, count(*) OVER (PARTITION BY tid) AS k FROM exon),
lx AS (SELECT 'start' AS kind, chrom, strand, e AS a, 0 AS b, is_ref, true AS flag FROM ix WHERE k > 1 AND i = 1 UNION ALL SELECT 'end', chrom, strand, s, 0, is_ref, true FROM ix WHERE k > 1 AND i = k UNION ALL SELECT 'exon', chrom, strand, s, e, is_ref, k > 1 AND i > 1 AND i < k FROM ix
  UNION ALL SELECT 'exon', x.chrom, x.strand, x.s, x.e, true, true FROM coded c JOIN exon x ON x.tid = c.tid_b WHERE c.ccode = '_' AND c.strand_a = c.strand_b),
lf AS (SELECT bool_or(is_ref) AS in_ref, bool_or(NOT is_ref) AS in_pred FROM lx GROUP BY kind, chrom, strand, a, b HAVING bool_or(flag))"""
PER_MODEL = """best AS (SELECT tid_a AS tid, false AS is_ref, max(CASE WHEN j_f1 >= 1 THEN n_f1 END) AS eq, max(n_f1) AS top, bool_or(ccode = '_') AS mono FROM coded GROUP BY tid_a UNION ALL SELECT tid_b, true, max(CASE WHEN j_f1 >= 1 THEN n_f1 END), max(n_f1), bool_or(ccode = '_') FROM coded GROUP BY tid_b),
txs AS (SELECT t.tid, t.gid, t.is_ref, coalesce(eq, CAST(-1 AS DOUBLE)) AS eq, coalesce(top, 0) <= 0 AS private, coalesce(mono, false) AS mono FROM transcript t LEFT JOIN best b ON b.tid = t.tid AND b.is_ref = t.is_ref),
gns AS (SELECT gid, is_ref, max(eq) AS eq, bool_and(private) AS private FROM txs GROUP BY gid, is_ref)"""


def level_sql(source: str, kind: str, cond: str) -> str:
    return f"SELECT '{kind}' AS key, count(CASE WHEN {cond} AND is_ref THEN 1 END) AS common_ref, count(CASE WHEN {cond} AND NOT is_ref THEN 1 END) AS common_pred, count(CASE WHEN NOT is_ref THEN 1 END) AS pred, count(CASE WHEN is_ref THEN 1 END) AS ref FROM {source}"


LEVELS = {kind: " UNION ALL ".join(level_sql(source, f"{kind}{x}", f"eq >= CAST({x} AS DOUBLE) / 100") for x in evaluate.FOUND) for kind, source in (("tx", "txs"), ("gene", "gns"))}


@query(LEVELS["tx"], f"{PAIRS}, {PER_MODEL}")
def stats_transcript_level(t) -> DataFrame:
    t.keep("exon")
    return evaluate.found_levels(t.transcript, compared(t)).filter("key IN ('tx100', 'tx95', 'tx80')")


@query(LEVELS["gene"], f"{PAIRS}, {PER_MODEL}")
def stats_gene_level(t) -> DataFrame:
    t.keep("exon")
    return evaluate.found_levels(t.transcript, compared(t)).filter("key IN ('gene100', 'gene95', 'gene80')")


@query(RATES, f"{PAIRS}, {LENIENT}, {COUNTS.replace('FROM flag', 'FROM lf')}")
def stats_exon_lenient(t) -> DataFrame:
    t.keep("exon")
    return evaluate.lenient_confusion(t.exon, single(t, compared(t)))


FEATURES = {"exon": ("exon", "chrom, strand, s, e"), "intron": ("intron", "chrom, strand, s, e"), "splice": ("sites", "chrom, strand, pos, kind"), "chain": ("chains", "chrom, strand, chain")}
SOURCES = f"{SITE}, sites AS (SELECT s.*, tid % 3 = 0 AS is_ref FROM site s), {CHAIN}, chains AS (SELECT *, tid % 3 = 0 AS is_ref FROM chain)"


def report_sql() -> tuple[str, str]:
    more, rows = [SOURCES], []
    for k, (source, keys) in FEATURES.items():
        more.append(flags(source, keys).replace("flag AS", f"flag_{k} AS", 1))
        rows.append(f"SELECT '{k}' AS feature, count(CASE WHEN in_ref AND in_pred THEN 1 END) AS common, count(CASE WHEN in_pred THEN 1 END) AS pred, count(CASE WHEN in_ref THEN 1 END) AS ref FROM flag_{k}")
    return f"SELECT *, CAST(100 AS DOUBLE) * common / ref AS sn, CAST(100 AS DOUBLE) * common / pred AS pr FROM ({' UNION ALL '.join(rows)})", ", ".join(more)


def report(t) -> DataFrame:
    is_ref = F.col("tid") % 3 == 0
    of = {"exon": t.exon, "intron": t.intron, "splice": model.splice_sites(t.intron).withColumn("is_ref", is_ref), "chain": model.intron_chain(t.intron).withColumn("is_ref", is_ref)}
    rows = [evaluate.feature_confusion(of[k], keys.split(", ")).select(F.lit(k).alias("feature"), "common", "pred", "ref", "sn", "pr") for k, (_, keys) in FEATURES.items()]
    return reduce(DataFrame.unionAll, rows)


def facts_sql() -> str:
    """Table expressions up to `facts`."""
    more = [PAIRS, LENIENT, PER_MODEL, union_of("is_ref", "ur"), union_of("NOT is_ref", "up"), SOURCES]
    rows = ["""SELECT 'base' AS key, c AS common_ref, c AS common_pred, (SELECT CAST(sum(e - s) AS BIGINT) FROM upm) AS pred, (SELECT CAST(sum(e - s) AS BIGINT) FROM urm) AS ref FROM
  (SELECT CAST(sum(least(a.e, b.e) - greatest(a.s, b.s)) AS BIGINT) AS c FROM urm a JOIN upm b ON a.chrom = b.chrom AND a.strand = b.strand AND a.s < b.e AND b.s < a.e)"""]
    for k, (source, keys) in FEATURES.items():
        more.append(flags(source, keys).replace("flag AS", f"flag_{k} AS", 1))
        n = "count(CASE WHEN in_ref AND in_pred THEN 1 END)"
        rows.append(f"SELECT '{k}{'' if k in ('exon', 'splice') else '_nr'}', {n}, {n}, count(CASE WHEN in_pred THEN 1 END), count(CASE WHEN in_ref THEN 1 END) FROM flag_{k}")
        if k in ("intron", "chain"):
            rows.append(f"SELECT '{k}', CAST(sum(CASE WHEN in_ref AND in_pred THEN n_ref ELSE 0 END) AS BIGINT), CAST(sum(CASE WHEN in_ref AND in_pred THEN n_pred ELSE 0 END) AS BIGINT), CAST(sum(n_pred) AS BIGINT), CAST(sum(n_ref) AS BIGINT) FROM flag_{k}")
    rows.append("SELECT 'exon_lenient', count(CASE WHEN in_ref AND in_pred THEN 1 END), count(CASE WHEN in_ref AND in_pred THEN 1 END), count(CASE WHEN in_pred THEN 1 END), count(CASE WHEN in_ref THEN 1 END) FROM lf")
    rows += [LEVELS["tx"], LEVELS["gene"], level_sql("txs", "tx_private", "private"), level_sql("gns", "gene_private", "private"), level_sql("txs", "mono", "mono")]
    return ", ".join([*more, f"facts AS MATERIALIZED ({' UNION ALL '.join(rows)})"])


def rows_sql() -> str:
    quote, null = (lambda x: f"'{x}'"), "CAST(NULL AS DOUBLE)"
    listed = lambda rows, first: ", ".join(f"({i}, {', '.join(map(quote, r))})" for i, r in enumerate(rows, first))
    per = lambda a, b: f"CASE WHEN {b} > 0 THEN CAST(100 AS DOUBLE) * {a} / {b} ELSE CAST(0 AS DOUBLE) END"
    levels = f"SELECT i AS row, name, sn, pr, CASE WHEN sn + pr > 0 THEN 2 * sn * pr / (sn + pr) ELSE CAST(0 AS DOUBLE) END AS f1, CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS total, {null} AS percent FROM (SELECT i, name, {per('common_ref', 'ref')} AS sn, {per('common_pred', 'pred')} AS pr FROM (VALUES {listed(evaluate.LEVEL_ROWS, 1)}) v(i, name, k) JOIN facts ON key = k)"
    counts = f"SELECT i, name, {null}, {null}, {null}, CAST(sum(CASE WHEN side = 'common_ref' THEN common_ref ELSE common_pred END) AS BIGINT), NULL, {null} FROM (VALUES {listed([(n, s, ','.join(k)) for n, s, k in evaluate.COUNT_ROWS], 15)}) v(i, name, side, k) JOIN facts ON list_contains(string_split(k, ','), key) GROUP BY i, name"
    missed = f"SELECT i, name, {null}, {null}, {null}, total - c, total, CASE WHEN c > 0 THEN CAST(100 AS DOUBLE) * (total - c) / total ELSE CAST(0 AS DOUBLE) END FROM (SELECT i, name, CASE WHEN side = 'ref' THEN ref ELSE pred END AS total, CASE WHEN side = 'ref' THEN common_ref ELSE common_pred END AS c FROM (VALUES {listed(evaluate.MISSED_ROWS, 21)}) v(i, name, side, k) JOIN facts ON key = k)"
    private = f"SELECT i, name, {null}, {null}, {null}, c, total, {per('c', 'total')} FROM (SELECT i, name, CASE WHEN side = 'ref' THEN ref ELSE pred END AS total, CASE WHEN side = 'ref' THEN common_ref ELSE common_pred END AS c FROM (VALUES {listed(evaluate.PRIVATE_ROWS, 27)}) v(i, name, side, k) JOIN facts ON key = k)"
    return f"{levels} UNION ALL {counts} UNION ALL {missed} UNION ALL {private}"


@query(rows_sql(), facts_sql())
def compare_stats_report(t) -> DataFrame:
    """The whole report of a comparison: fourteen levels, six counts, ten rows of what is missed or new."""
    return evaluate.stats_report(facts(t))


TWO = "format('{{:.2f}}', floor({0} * 100 + CAST(0.5 AS DOUBLE)) / 100)"
LINES = f"""SELECT row, lpad(name, 34, ' ') || ': ' || CASE WHEN sn IS NOT NULL THEN {TWO.format('sn')} || '  ' || {TWO.format('pr')} || '  ' || {TWO.format('f1')} WHEN total IS NULL THEN CAST(n AS VARCHAR) ELSE n || '/' || total || '  (' || {TWO.format('percent')} || '%)' END AS value FROM ({rows_sql()})"""


@query(LINES, facts_sql())
def sink_stats(t) -> DataFrame:
    """The report as the lines of its file, written in order and read back."""
    path = f"{graph.shared_dir(t.spark)}/stats-{uuid.uuid4().hex}"
    formats.write_stats(evaluate.stats_report(facts(t)), path)
    return formats.scan_stats(t.spark, path)


@query(f"SELECT {', '.join(f'max(CASE WHEN feature = {chr(39)}{k}{chr(39)} THEN sn END) AS {k}_sn, max(CASE WHEN feature = {chr(39)}{k}{chr(39)} THEN pr END) AS {k}_pr' for k in FEATURES)} FROM ({report_sql()[0]})", report_sql()[1])
def collapse_compare_stats(t) -> DataFrame:
    p = report(t).groupBy().pivot("feature", list(FEATURES)).agg(F.max("sn").alias("sn"), F.max("pr").alias("pr"))
    return p.select(*[f"{k}_{x}" for k in FEATURES for x in ("sn", "pr")])


@query("SELECT tid_a, tid_b, distance FROM (SELECT a.tid AS tid_a, b.gid AS tid_b, greatest(0, greatest(a.s, b.s) - least(a.e, b.e)) AS distance, min(greatest(0, greatest(a.s, b.s) - least(a.e, b.e))) OVER (PARTITION BY a.tid) AS d FROM transcript a JOIN (SELECT gid, chrom, min(s) AS s, max(e) AS e FROM transcript WHERE is_ref GROUP BY 1, 2) b ON a.chrom = b.chrom AND greatest(a.s, b.s) - least(a.e, b.e) <= 2000 WHERE NOT a.is_ref) WHERE distance = d")
def assign_candidates(t) -> DataFrame:
    """Reference genes at the least distance from each prediction, within 2000 bases."""
    g = t.transcript.filter("is_ref").groupBy(F.col("gid").alias("tid"), "chrom").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    d = intervals.join_within_distance(t.transcript.filter("NOT is_ref").select("chrom", "tid", "s", "e"), g.select("chrom", "tid", "s", "e"), 2000)
    return d.withColumn("d", F.min("distance").over(Window.partitionBy("tid_a"))).filter("distance = d").select("tid_a", "tid_b", "distance")


@query("SELECT tid_a, count(DISTINCT g.gid) AS n_genes, min(g.gid) AS first_gene FROM coded c JOIN transcript g ON g.tid = c.tid_b WHERE strand_a = strand_b AND (j_f1 > 0 OR n_recall >= 0.1) GROUP BY tid_a HAVING count(DISTINCT g.gid) >= 2", pair_sql(0))
def assign_fusion(t) -> DataFrame:
    """Predictions that match two reference genes or more on their strand, by a splice site or a tenth of the bases."""
    p = compare.compare_pairs(*sides(t)).filter("strand_a = strand_b AND (j_f1 > 0 OR n_recall >= 0.1)")
    g = t.transcript.select(F.col("tid").alias("tid_b"), "gid")
    return p.join(g, "tid_b").groupBy("tid_a").agg(F.count_distinct("gid").alias("n_genes"), F.min("gid").alias("first_gene")).filter("n_genes >= 2")


@query("SELECT t.tid, CAST(t.tid % 4 AS BIGINT) AS source_score, max(CASE WHEN l.source = 'tpm' THEN score END) AS external_tpm, max(CASE WHEN l.source = 'frac' THEN score END) AS external_frac FROM transcript t JOIN long l ON t.tid = l.tid GROUP BY t.tid", EXTERNAL)
def metrics_source(t) -> DataFrame:
    o = t.spark.read.parquet(f"{t.sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("tid"), F.col("o_totalprice").cast("double").alias("tpm"), (F.col("o_custkey") % 100 / F.lit(100.0)).alias("frac"))
    wide = evidence.external_long(o, ["tpm", "frac"]).groupBy("tid").pivot("source", ["tpm", "frac"]).agg(F.max("score"))
    return t.transcript.select("tid", F.regexp_extract("source", "[0-9]+", 0).cast("long").alias("source_score")).join(wide, "tid").select("tid", "source_score", F.col("tpm").alias("external_tpm"), F.col("frac").alias("external_frac"))


@query()
def metric_importance(t) -> DataFrame:
    """How much each metric tells about a prediction's agreement with the reference, by a random forest."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    names = ["cdna_length", "exon_num", "max_exon_length", "min_exon_length", "max_intron_length", "combined_cds_fraction"]
    label = compare.compare_pairs(*sides(t)).groupBy(F.col("tid_a").alias("tid")).agg(F.max("n_f1").alias("label"))
    m = model.cdna_metrics(t.exon).join(model.intron_metrics(t.exon, t.intron), "tid").join(model.cds_metrics(t.exon, t.cds), "tid").join(label, "tid")
    fit = RandomForestRegressor(featuresCol="v", labelCol="label", numTrees=max(1, len(names) // 3), maxDepth=5, seed=1).fit(VectorAssembler(inputCols=names, outputCol="v").transform(m))
    return t.spark.createDataFrame([(n, float(x)) for n, x in zip(names, fit.featureImportances.toArray())], "metric string, importance double")
