"""Attributes are parsed once a line, whatever is asked of them, and as the rule by hand says."""

import re

from pyspark.sql import functions as F

from splicedf import plans
from splicedf.sources import formats
from tests.conftest import SF

GTF = ['gene_id "g;1"; transcript_id t1 ; tag "a"; note "x y"; tag b; tag "";', 'gene_id "g2"; transcript_id "t2";', 'transcript_id "t3";', "gene_id ; x 1", "gene_id g5;gene_id g6; transcript_id  t5"]
GFF3 = ["ID=a;Parent=p1,p2;Note=x%3By;Note=z", " ID=b ; Parent = q ;;flag;k=v=w", "Parent=p%2C1;note=100%;Note=+", "id=c", "ID=d;ID=e"]


def lines(spark, last):
    return spark.createDataFrame([(f"chr1\tsrc\texon\t{i + 1}\t{i + 9}\t.\t+\t.\t{a}",) for i, a in enumerate(last)], "value string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def folded(pairs):
    out = {}
    for k, v in pairs:
        out.setdefault(k, []).append(v)
    return {k: ",".join(v) for k, v in out.items()}


def test_gtf(spark):
    d = formats.scan_gtf(lines(spark, GTF))
    got = {r.s: (r.attributes, r.gid, r.tid) for r in d.collect()}
    want = {}
    for i, a in enumerate(GTF):
        m = folded((k, b.strip(" ") if b else q) for k, q, b in re.findall(r'([A-Za-z_][A-Za-z0-9_]*) +(?:"([^"]*)"|([^";]+))', a))
        if "gene_id" in m:
            want[i + 1] = (m, m["gene_id"], m.get("transcript_id"))
    assert got == want and len(want) == 3
    assert plan(d.filter("tid <> 'x' AND gid <> 'y'").select("tid", "gid", F.col("attributes")["tag"])).count("regexp_extract_all") == 2


def test_gff3(spark):
    d = formats.scan_gff3(lines(spark, GFF3))
    got = sorted((r.s, r.id, r.parent, r.attributes) for r in d.filter("s < 5").collect())
    a = [{"ID": "a", "Parent": "p1,p2", "Note": "x;y,z"}, {"ID": "b", "Parent ": " q", "flag": "", "k": "v=w"}, {"Parent": "p,1", "note": "100%", "Note": "+"}, {"id": "c"}]
    assert got == [(1, "a", "p1", a[0]), (1, "a", "p2", a[0]), (2, "b", None, a[1]), (3, None, "p,1", a[2]), (4, "c", None, a[3])]
    assert [r.id for r in d.filter("s = 5").collect()] == ["d,e"]
    assert plan(d.filter("id <> 'x' AND parent <> 'y'").select("id", "parent", F.col("attributes")["Note"])).count("regexp_extract(") == 1


def test_conversion_reads_its_rows_from_a_table(spark):
    assert "regexp_extract_all" not in plan(plans.QUERIES["convert_format"](spark, SF))
