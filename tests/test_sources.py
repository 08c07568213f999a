"""Files as others write them: repeated keys, escapes, headers with signs, odd columns, alignments; what is refused."""

import pytest

from splicedf.sources import formats

GTF = """#!genome-build x
1\thavana\ttranscript\t11\t90\t.\t+\t.\tgene_id "G1"; transcript_id "T1"; tag "basic"; tag "CCDS"; note "a; b"; level 2;
1\thavana\texon\t11\t30\t.\t+\t.\tgene_id "G1"; transcript_id "T1"; exon_number 1; tag "basic"; tag "CCDS";
1\thavana\tCDS\t21\t30\t.\t+\t0\tgene_id "G1"; transcript_id "T1"; ont "x"; ont "x"; ont "y";
1\thavana\texon\t51\t90\t.\t.\t.\tgene_id "G2"; transcript_id "T2"
1\thavana\texon\t51\t90\t.\t.\t.\ttranscript_id "T3"
short line
"""
GFF = """##gff-version 3
1\tx\tgene\t1\t90\t.\t+\t.\tID=g%2C1;Name=A%3BB+C;Alias=p;Alias=q;
1\tx\tmRNA\t1\t90\t.\t+\t.\tID=t1;Parent=g%2C1;Note=bad%ZZ
1\tx\texon\t1\t30\t.\t+\t.\tParent=t1,t2;empty=;flag
1\tx\tcDNA_match\t5\t20\t99\t-\t.\tID=m1;Target=EST1 1 16 +
1\tx\tcDNA_match\t40\t60\t99\t-\t.\tID=m1;Target=EST1 17 37 +
2\tx\tcDNA_match\t5\t9\t.\t+\t.\tID=m2;Target=E 1 5 +
3\tx\tcDNA_match\t5\t9\t.\t+\t.\tID=m2;Target=E 1 5 +
1\tx\tmatch\t100\t200\t.\t+\t.\tID=m3
1\tx\tmatch_part\t100\t120\t.\t+\t.\tID=m3.1;Parent=m3
1\tx\tmatch_part\t150\t200\t.\t+\t.\tID=m3.2;Parent=m3
1\tx\tcDNA_match\t7\t9\t.\t+\t.\tTarget=only 1 3 +
"""


def lines(spark, text):
    return spark.createDataFrame([(x,) for x in text.splitlines()], "value string")


def test_gtf_with_repeated_keys(spark):
    got = {(r["tid"], r["feature"]): r for r in formats.scan_gtf(lines(spark, GTF)).collect()}
    assert set(got) == {("T1", "transcript"), ("T1", "exon"), ("T1", "CDS"), ("T2", "exon")}
    t = got["T1", "transcript"]
    assert t["attributes"]["tag"] == "basic,CCDS" and t["attributes"]["note"] == "a; b" and t["attributes"]["level"] == "2"
    assert got["T1", "CDS"]["attributes"]["ont"] == "x,x,y" and got["T1", "CDS"]["phase"] == 0
    assert got["T2", "exon"]["strand"] is None and got["T2", "exon"]["gid"] == "G2"


def test_gff3_with_escapes_and_repeated_keys(spark):
    got = formats.scan_gff3(lines(spark, GFF)).collect()
    gene = next(r for r in got if r["feature"] == "gene")
    assert gene["id"] == "g,1" and gene["attributes"]["Name"] == "A;B+C" and gene["attributes"]["Alias"] == "p,q"
    rna = next(r for r in got if r["feature"] == "mRNA")
    assert rna["parent"] == "g,1" and rna["attributes"]["Note"] == "bad%ZZ"
    exons = [r for r in got if r["feature"] == "exon"]
    assert sorted(r["parent"] for r in exons) == ["t1", "t2"] and exons[0]["attributes"]["empty"] == ""


def test_alignments_are_models(spark):
    got = {}
    for r in formats.scan_cdna_match(lines(spark, GFF)).collect():
        got.setdefault(r["tid"], []).append((r["chrom"], r["s"], r["e"]))
    assert {t: sorted(x) for t, x in got.items()} == {"m1": [("1", 5, 20), ("1", 40, 60)], "m2.2": [("2", 5, 9)], "m2.3": [("3", 5, 9)], "m3": [("1", 100, 120), ("1", 150, 200)], "only": [("1", 7, 9)]}


def test_matches_without_parts_are_models_of_one_exon(spark):
    row = "1\tx\t{}\t{}\t{}\t.\t+\t.\t{}".format
    text = [row("match", 5, 20, "ID=a;Target=E 1 16 +"), row("match", 5, 20, "ID=a;Target=E 1 16 +"), row("match", 1, 90, "ID=b"), row("match_part", 1, 9, "Parent=b"), row("match", 40, 60, "Target=only 1 21 +"), row("match", 1, 9, "ID=c"), row("match", 20, 29, "ID=c"), row("match", 1, 9, "ID=d"), "2" + row("match", 1, 9, "ID=d")[1:]]
    got = sorted((r["tid"], r["chrom"], r["s"], r["e"]) for r in formats.scan_cdna_match(lines(spark, "\n".join(text))).collect())
    assert got == [("a", "1", 5, 20), ("b", "1", 1, 9), ("d.1", "1", 1, 9), ("d.2", "2", 1, 9), ("only", "1", 40, 60)]


def test_exons_of_coding_and_untranslated_segments(spark):
    rows = [("a", "1", "+", f, s, e) for f, s, e in (("five_prime_UTR", 1, 9), ("CDS", 10, 20), ("CDS", 31, 40), ("three_prime_UTR", 41, 50))] + [("b", "1", "+", "exon", 1, 5), ("b", "1", "+", "CDS", 2, 5)]
    got = formats.model_exons(spark.createDataFrame(rows, "tid string, chrom string, strand string, feature string, s long, e long"))
    assert sorted((r["tid"], r["s"], r["e"]) for r in got.collect()) == [("a", 1, 20), ("a", 31, 50), ("b", 1, 5)]


def test_fasta_headers_with_signs(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">s1 protein A->B >c\nACGT\nAC\n\n>s2\n>s3\r\nGG\r\nTT\n")
    got = {r["name"]: (r["seq"], r["length"]) for r in formats.scan_fasta(spark, str(tmp_path / "x.fa")).collect()}
    assert got == {"s1": ("ACGTAC", 6), "s2": ("", 0), "s3": ("GGTT", 4)}


def test_external_tables(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("tid\ttpm\tfrac\nt1\t1.5\tNaN\nt2\t\t0.25\n")
    got = sorted(map(tuple, formats.scan_external(spark, str(tmp_path / "x.tsv")).collect()))
    assert got == [("t1", "frac", 0.0), ("t1", "tpm", 1.5), ("t2", "frac", 0.25)]
    (tmp_path / "y.csv").write_text("tid,tpm\nt1,2\n")
    assert list(map(tuple, formats.scan_external(spark, str(tmp_path / "y.csv"), sep=",").collect())) == [("t1", "tpm", 2.0)]
    (tmp_path / "z.tsv").write_text("tid\ttpm\ttpm\nt1\t1\t2\n")
    with pytest.raises(ValueError, match="tpm"):
        formats.scan_external(spark, str(tmp_path / "z.tsv"))


def test_hits_with_and_without_traces(spark):
    own = "q\tt\t90.0\t10\t1\t0\t1\t10\t2\t11\t1e-9\t55"
    d = lines(spark, "\n".join(["# head", own, own + "\t95.0\t5AB4", "too\tfew", own.replace("90.0", "many")]))
    got = formats.scan_blast_tab(d).collect()
    assert [(r["ppos"], r["btop"]) for r in got] == [(None, None), (95.0, "5AB4")] and got[0]["tstart"] == 2
    assert sorted(r["reason"] for r in formats.blast_tab_rejects(d).collect()) == ["columns", "number"]


def test_a_name_in_two_assemblies_is_an_error(spark):
    of = lambda *ids: spark.createDataFrame([(i, "g") for i in ids], "tid string, gid string")
    assert sorted(r["tid"] for r in formats.union_assemblies([("a", of("x", "x")), ("b", of("x"))]).collect()) == ["a_x", "a_x", "b_x"]
    with pytest.raises(Exception, match="two assemblies"):
        formats.union_assemblies([("", of("b_x")), ("b", of("x"))]).collect()


def test_coding_segments_through_bed12(spark):
    exon = spark.createDataFrame([(7, 1, "c", "-", "s", 101, 150), (7, 1, "c", "-", "s", 201, 260)], "tid long, gid long, chrom string, strand string, source string, s long, e long")
    transcript = spark.createDataFrame([(7, 1, "c", "-", "s", 101, 260)], exon.schema)
    cds = spark.createDataFrame([(7, 120, 150), (7, 201, 230)], "tid long, s long, e long")
    rows = formats.scan_bed12(formats.bed12_lines(transcript, exon, cds))
    assert sorted((r["s"], r["e"], r["phase"]) for r in formats.bed12_cds(rows).collect()) == [(120, 150, 0), (201, 230, 0)]
    assert [(r["s"], r["phase"]) for r in formats.scan_gtf(formats.gtf_lines(transcript, exon, cds)).filter("feature = 'CDS'").orderBy("s").collect()] == [(120, 0), (201, 0)]
    plain = formats.scan_bed12(formats.bed12_lines(transcript, exon))
    assert formats.bed12_cds(plain).collect() == [] and plain.count() == 2


def test_frames_of_callers(spark):
    from splicedf.sources import tables

    bed = "t1\t0\t300\tID=x;phase=2;ORF_type=complete\t0\t+\t30\t90\t0\t1\t300\t0\nt2\t0\t300\tx\t0\t-\t0\t60\t0\t1\t300\t0\nt3\t0\t300\tx\t0\t+\t10\t10\t0\t1\t300\t0\ntrack x"
    assert sorted(map(tuple, tables.scan_orf_bed12(lines(spark, bed)).collect())) == [("t1", 31, 90, "+", 2, True), ("t2", 1, 60, "-", 0, False)]
    gff = "t1\tp\tCDS\t3\t50\t9.1\t-\t0\tID=1;partial=10\nt1\tp\tCDS\t60\t90\t.\t+\t.\tID=2\nt1\tp\texon\t60\t90\t.\t+\t.\tID=2"
    assert sorted(map(tuple, tables.scan_orf_gff3(lines(spark, gff)).collect())) == [("t1", 3, 50, "-", 0, False), ("t1", 60, 90, "+", 0, True)]


def test_sheets(spark):
    from splicedf.sources import tables

    good = "# file\tlabel\na.gtf\ta\tTrue\t1.5\tFalse\tTrue\n\nb.gtf\tb\n"
    assert sorted(map(tuple, tables.scan_input_sheet(lines(spark, good)).collect())) == [("a.gtf", "a", True, 1.5, False, True), ("b.gtf", "b", False, 0.0, False, False)]
    for bad, why in (("a.gtf\ta\nb.gtf\ta", "label named twice"), ("a.gtf\ta\na.gtf\tb", "file named twice"), ("a.gtf", "without label")):
        with pytest.raises(Exception, match=why):
            tables.scan_input_sheet(lines(spark, bad)).collect()


def test_hits_in_xml(spark, tmp_path):
    from splicedf.sources import tables

    (tmp_path / "x.xml").write_text("""<?xml version="1.0"?>
<BlastOutput><BlastOutput_program>blastx</BlastOutput_program><BlastOutput_iterations>
<Iteration><Iteration_iter-num>1</Iteration_iter-num><Iteration_query-def>q1 a description</Iteration_query-def><Iteration_query-len>300</Iteration_query-len>
<Iteration_hits><Hit><Hit_num>1</Hit_num><Hit_id>t1</Hit_id><Hit_len>90</Hit_len><Hit_hsps>
<Hsp><Hsp_num>1</Hsp_num><Hsp_bit-score>50.5</Hsp_bit-score><Hsp_evalue>1e-09</Hsp_evalue><Hsp_query-from>1</Hsp_query-from><Hsp_query-to>90</Hsp_query-to><Hsp_hit-from>1</Hsp_hit-from><Hsp_hit-to>30</Hsp_hit-to><Hsp_identity>15</Hsp_identity><Hsp_positive>24</Hsp_positive><Hsp_align-len>30</Hsp_align-len><Hsp_midline>A+ C</Hsp_midline></Hsp>
<Hsp><Hsp_num>2</Hsp_num><Hsp_bit-score>20</Hsp_bit-score><Hsp_evalue>0.1</Hsp_evalue><Hsp_query-from>100</Hsp_query-from><Hsp_query-to>120</Hsp_query-to><Hsp_hit-from>40</Hsp_hit-from><Hsp_hit-to>46</Hsp_hit-to><Hsp_identity>7</Hsp_identity><Hsp_positive>7</Hsp_positive><Hsp_align-len>7</Hsp_align-len></Hsp>
</Hit_hsps></Hit></Iteration_hits></Iteration>
<Iteration><Iteration_query-def>q2</Iteration_query-def><Iteration_query-len>30</Iteration_query-len><Iteration_hits></Iteration_hits></Iteration>
<Iteration><Iteration_query-def>q3</Iteration_query-def><Iteration_query-len>30</Iteration_query-len></Iteration>
</BlastOutput_iterations></BlastOutput>
""")
    got = sorted((r["query"], r["target"], r["tlen"], r["n"], r["bitscore"], r["evalue"], r["qend"], r["identity"], r["ppos"]) for r in tables.scan_blast_xml(spark, str(tmp_path / "x.xml")).collect())
    assert got == [("q1", "t1", 90, 1, 50.5, 1e-9, 90, 50.0, 80.0), ("q1", "t1", 90, 2, 20.0, 0.1, 120, 100.0, 100.0)]


def test_written_hits_are_packed(spark, tmp_path):
    """XML of 20,000 hits, read back whole; before, the files had 500 bytes a hit."""
    from splicedf.sources import tables

    d = spark.range(20_000).selectExpr("id div 5 AS query", "900L AS qlen", "id % 5 AS target", "800L AS tlen", "1 AS n", "CAST(id AS DOUBLE) AS bitscore", "1e-5D AS evalue", "1L AS qstart", "id AS qend", "1L AS tstart", "9L AS tend", "5L AS identities", "6L AS positives", "10L AS length")
    tables.write_blast_xml(d, str(tmp_path / "x"))
    assert sum(p.stat().st_size for p in (tmp_path / "x").iterdir()) < 100 * 20_000
    back = tables.scan_blast_xml(spark, str(tmp_path / "x"))
    assert back.count() == 20_000 and back.select("query", "target", "qend").distinct().count() == 20_000
