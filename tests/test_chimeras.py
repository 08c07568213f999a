"""Chimeras: the modes on made frames and hits by a loop over neighbours, cut models base by base, hits by sets of positions."""

import random

import pytest

from splicedf.operators import chimeras

ORF, HSP = "tid long, s long, e long", "tid long, target string, tlen long, qs long, qe long, ts long, te long, evalue double, bits double, match string"


def shared(a, b):
    return min(a[1], b[1]) - max(a[0], b[0])


def made(seed):
    r, orfs, hsps = random.Random(seed), {}, {}
    for tid in range(1, 60):
        at, own = 1 + r.randint(0, 30), []
        for _ in range(r.randint(1, 4)):
            n = r.randint(40, 120)
            own.append((at, at + n))
            at += n + r.choice([0, 1, 5, 40])
        orfs[tid], hsps[tid] = own, []
        for _ in range(r.randint(0, 6)):
            f = r.choice(own)
            s = max(1, f[0] + r.randint(-60, 60))
            target = r.choice("abc")
            ts = r.choice([1, 1, 10, 60])
            hsps[tid].append((tid, target, {"a": 100, "b": 60, "c": 40}[target], s, s + r.randint(20, 150), ts, ts + r.randint(10, 45), r.choice([1e-9, 1e-7, 1e-3]), float(r.randint(20, 90)), "".join(r.choice("AAAK|+_ -") for _ in range(r.randint(0, 40)))))
    return orfs, hsps


def parted(orfs, hsps, mode):
    """Part numbers of a model's frames, from left to right."""
    hits = []
    for f in orfs:
        own = {}
        for h in hsps:
            if h[7] <= 1e-6 and shared(f, h[3:5]) >= 0.5 * (f[1] + 1 - f[0]):
                own.setdefault(h[1], []).append(h)
        hits.append(own)
    out = [1]
    for old, new in zip(hits, hits[1:]):
        if mode in ("NOSPLIT", "SPLIT"):
            cut = mode == "SPLIT"
        elif not old and not new:
            cut = mode != "STRINGENT"
        elif not old or not new:
            cut = mode == "PERMISSIVE"
        else:
            cut = True
            for t in old.keys() & new.keys():
                for a in old[t]:
                    for b in new[t]:
                        if shared(a[3:5], b[3:5]) >= 0 or (shared(a[5:7], b[5:7]) >= 0 and shared(a[5:7], b[5:7]) / a[2] < 0.8):
                            cut = False
        out.append(out[-1] + cut)
    return out


@pytest.fixture(scope="module")
def tables(spark):
    orfs, hsps = made(1)
    o = spark.createDataFrame([(t, *f) for t, v in orfs.items() for f in v], ORF)
    h = spark.createDataFrame([x for v in hsps.values() for x in v], HSP)
    return orfs, hsps, o, h


@pytest.fixture(scope="module")
def evidence(tables):
    return chimeras.frame_evidence(tables[2], tables[3]).cache()


@pytest.mark.parametrize("mode", chimeras.MODES)
def test_modes(tables, evidence, mode):
    orfs, hsps, _, _ = tables
    got = {}
    for r in chimeras.chimera_decide(evidence, mode).collect():
        got.setdefault(r["tid"], []).append((r["s"], r["e"], r["part"], r["from"], r["to"]))
    seen = set()
    for tid, own in orfs.items():
        parts = parted(own, hsps[tid], mode)
        seen.add(parts[-1])
        want = []
        for (s, e), p in zip(own, parts):
            run = [f for f, q in zip(own, parts) if q == p]
            want.append((s, e, p, run[0][0], run[-1][1]))
        assert sorted(got[tid]) == want
    assert len(seen) > 1 or mode == "NOSPLIT"


def test_unknown_mode(evidence):
    with pytest.raises(ValueError):
        chimeras.chimera_decide(evidence, "OFTEN")


def cut(exons, strand, parts):
    """Genomic bases of each part, base by base along the transcript, and where the part starts there."""
    along = sorted(exons, reverse=strand == "-")
    bases = [p for s, e in along for p in (range(s, e + 1) if strand == "+" else range(e, s - 1, -1))]
    edges, at = [], 0
    for s, e in along:
        edges.append((at + 1, at + e - s + 1))
        at += e - s + 1
    out = []
    for k, (f, t) in enumerate(parts):
        lo = 1 if k == 0 else f - 1 if any(e == f and s < f for s, e in edges) else f
        hi = at if k == len(parts) - 1 else t + 1 if any(s == t and e > t for s, e in edges) else t
        out.append((set(bases[lo - 1 : hi]), lo, hi))
    return out


@pytest.mark.parametrize("strand", ["+", "-"])
def test_split_base_by_base(spark, strand):
    exons = [(101, 150), (201, 260), (301, 330), (401, 500)]  # 240 bases
    cases = {
        1: [(10, 60), (70, 120), (150, 230)],
        2: [(10, 49), (50, 100)] if strand == "+" else [(10, 99), (100, 200)],  # one base of an exon at the border
        3: [(10, 51), (80, 200)] if strand == "+" else [(10, 101), (120, 200)],
        4: [(10, 100)],
        5: [(10, 51), (51, 200)] if strand == "+" else [(10, 101), (101, 200)],  # two bases in common: a collision
    }
    x = spark.createDataFrame([(t, strand, *e) for t in cases for e in exons], "tid long, strand string, s long, e long")
    decided = spark.createDataFrame([(t, s, e, k + 1, s, e) for t, v in cases.items() for k, (s, e) in enumerate(v)], "tid long, s long, e long, part int, `from` long, `to` long")
    pieces, frames, stripped = chimeras.chimera_split(x, decided)
    assert [r["tid"] for r in stripped.collect()] == [5]
    got = {}
    for r in pieces.collect():
        got.setdefault((r["tid"], r["part"]), set()).update(range(r["s"], r["e"] + 1))
    placed = {(r["tid"], r["part"]): (r["s"], r["e"]) for r in frames.collect()}
    want, at = {}, {}
    for t in (1, 2, 3):
        for k, ((bases, lo, hi), (s, e)) in enumerate(zip(cut(exons, strand, cases[t]), cases[t])):
            want[t, k + 1], at[t, k + 1] = bases, (min(s, hi) - lo + 1, min(e, hi) - lo + 1)
    assert got == want and placed == at


def test_hits_of_parts(tables, evidence):
    orfs, hsps, _, h = tables
    got = {(r["tid"], r["part"], r["target"]): r for r in chimeras.chimera_hits(h, chimeras.chimera_decide(evidence, "PERMISSIVE")).collect()}
    want = 0
    for tid, own in orfs.items():
        parts = parted(own, hsps[tid], "PERMISSIVE")
        for p in set(parts):
            run = [f for f, q in zip(own, parts) if q == p]
            bound = (run[0][0], run[-1][1])
            for target in "abc":
                of = [x for x in hsps[tid] if x[1] == target]
                if not of or shared((min(x[3] for x in of), max(x[4] for x in of)), bound) <= 0:
                    continue
                kept = [x for x in of if shared(x[3:5], bound) >= 0.5 * (bound[1] + 1 - bound[0])]
                if not kept:
                    continue
                want += 1
                same, positive = set(), set()
                for x in kept:
                    pos = x[3] - 1
                    for c in x[9]:
                        if c.isalpha() or c in "|+":
                            pos += 1
                            positive.add(pos)
                            if c != "+":
                                same.add(pos)
                        elif c == "_":
                            pos += 1
                aligned = []
                for a, b in ((3, 4), (5, 6)):
                    runs = []
                    for s, e in sorted((x[a], x[b]) for x in kept):
                        if runs and s < runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], e)
                        else:
                            runs.append([s, e])
                    aligned.append(sum(e - s + 1 for s, e in runs))
                r = got[tid, p, target]
                assert (r["query_aligned"], r["target_aligned"]) == tuple(aligned) and r["n_hsps"] == len(kept)
                assert (r["bits"], r["evalue"]) == (max(x[8] for x in kept), min(x[7] for x in kept))
                assert r["identity"] == pytest.approx(len(same) * 100 / aligned[0]) and r["positives"] == pytest.approx(len(positive) * 100 / aligned[0])
    assert want == len(got) > 20


def test_hits_are_brought_together_by_model_once(spark):
    """What is grouped by model, and by part and target of it, stays where its model's lines are: before, thirty shuffles."""
    from splicedf import plans
    from tests.conftest import SF

    p = plans.QUERIES["chimera_hits"](spark, SF)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert 0 < p.count("Exchange hashpartitioning") <= 6


def test_hits_without_letters(spark):
    """HSPs whose match is missing, empty or holds no position have hits all the same; equal ones count twice."""
    rows = [(1, "a", 100, 1, 50, 1, 20, 1e-9, 30.0, m) for m in (None, "", "__", "-- ")] + [(1, "a", 100, 50, 90, 20, 40, 1e-8, 40.0, "_A+"), (1, "b", 100, 1, 90, 1, 9, 1e-3, 9.0, None)]
    decided = spark.createDataFrame([(1, 1, 90, 1, 1, 90)], "tid long, s long, e long, part int, `from` long, `to` long")
    got = {r["target"]: tuple(r)[3:] for r in chimeras.chimera_hits(spark.createDataFrame(rows, HSP), decided, 0.4).collect()}
    assert got == {"a": (40.0, 1e-9, 5, 1, 90, 91, 1, 40, 41, 100 / 91, 200 / 91), "b": (9.0, 1e-3, 1, 1, 90, 90, 1, 9, 9, 0.0, 0.0)}
