"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from splicedf.llm.common import Scratch
from splicedf.llm import decontaminate, jaccard_join, kd_sharding, license_scan, mixing, pii, pii_spans, quality_rules, sorted_tables, token_tables, warc, warc_records, weak_labels

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot string, n_words string"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 5))) for _ in range(300)]


def prose(n, r):
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def fixture():
    r = random.Random(1)
    texts = [prose(r.randint(1, 90), r) for _ in range(60)]
    base = prose(80, r).split()
    for k in range(25):  # near copies on both sides of the limit
        w = list(base)
        for _ in range(k % 5):
            w[r.randrange(len(w))] = r.choice(VOCABULARY)
        texts.append(" ".join(w))
    passage = prose(40, r)
    texts += [f"{prose(30, r)} {passage} {prose(30, r)}" for _ in range(12)]
    texts += [texts[3]] * 6 + [None, None, "", " \n\t ", "one", "One", "a b c", "Ünïcode Straße A b 汉字 test", prose(6000, r), "x\n\nx\nx\n y", "the $$$ | *** ###"]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s0", "s0", "s0", "s1", None]), r.choice([None, 5]), "x", "y") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (3, "another text of the same id", None, "s1", 1, "x", "y"), (None, "text without id", "en", "s2", 4, "x", "y"), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def ws(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def components(rows, k, num, den):
    sets = []
    for _, text, *_ in rows:
        w = ws(lowered(text))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                top[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), low.get(root(i), r[0])) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 4, 5)])
def test_jaccard_join(docs, k, num, den):
    got = rows_of(jaccard_join.near_duplicates(docs, k, num, den), "doc_id", "n_shingles", "component_id")
    assert got == components(fixture(), k, num, den)


def test_jaccard_join_near_misses(spark):
    """A large group whose members are mostly just below the limit to each other."""
    r = random.Random(9)
    base = prose(70, r).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 2, 3, 4])):
            w[r.randrange(len(w))] = f"own{r.randrange(10**6)}"
        rows.append((i, " ".join(w), None, None, None, None, None))
    rows = rows[1:] if rows[0][1] == " ".join(base) else rows
    got = rows_of(jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA), 4, 85, 100), "doc_id", "n_shingles", "component_id")
    assert got == components(rows, 4, 85, 100)


def test_one_of_each(docs, empty):
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[2] for r in components(fixture(), 5, 4, 5)}
    assert jaccard_join.near_duplicates(empty).count() == 0


def bench_rows(rows):
    long = ws(rows[5][1] or "")
    return [(0, " ".join(ws(rows[7][1])[:12])), (1, "Test"), (2, None), (3, ""), (4, " ".join(ws(rows[-6][1])[100:140])), (5, "A-B C"), (6, " ".join(long[:9])), (7, " ".join(ws(rows[7][1])[:12])), (None, "one")]


def contaminated(rows, bench, size=10):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    out = []
    for i, text, *_ in rows:
        w, hit, items = word(text), set(), set()
        for item, t in bench:
            b = word(t)
            n = min(len(b), size)
            for s in range(len(b) - n + 1) if b else ():
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == b[s : s + n]:
                        hit |= set(range(at, at + n))
                        items |= {str(item)} - {"None"}
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("set_rows", [100_000, 0])
def test_decontamination(spark, docs, set_rows):
    rows = fixture()
    bench = bench_rows(rows)
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = rows_of(decontaminate.report(docs, b, set_rows=set_rows), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == contaminated(rows, bench)
    clean = sorted((r[0] for r in contaminated(rows, bench) if not r[5]), key=repr)
    assert [r[0] for r in rows_of(decontaminate.decontaminate(docs, b, set_rows=set_rows), "doc_id")] == clean


def test_decontamination_spans(spark, docs):
    b = spark.createDataFrame([(0, " ".join(ws(fixture()[7][1])[:12]))], "item_id long, text string")
    cut = decontaminate.decontaminate(docs, b, remove="spans")
    assert cut.count() == docs.count() and cut.columns == docs.columns
    assert decontaminate.report(cut, b).filter("contaminated").count() == 0
    before, after = (dict(x.filter("doc_id <> 7").select("doc_id", "text").collect()) for x in (docs, cut))
    assert {k: v for k, v in after.items() if k > 3} == {k: v for k, v in before.items() if k > 3}


def test_decontamination_empty(spark, empty, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(empty, none).count() == 0
    assert decontaminate.report(docs, none).filter("contaminated OR n_hit > 0").count() == 0


def xx(b, seed=42):
    h = xxhash.xxh64_intdigest(b, seed)
    return h - (1 << 64) if h >= 1 << 63 else h


def xx_pair(a, b):
    return xx(b.to_bytes(8, "little", signed=True), xx(a.to_bytes(8, "little", signed=True)) % (1 << 64))


def quality(rows, labels):
    good = {}
    for i, q, t in labels:
        if i is not None:
            good.setdefault(i, []).append(q == 1 and not t)
    grams, raw, trust = [], [0] * quality_rules.BUCKETS, [0] * quality_rules.BUCKETS
    for i, text, *_ in rows:
        h = [xx(w.encode()) for w in ws(text)]
        g = [x % quality_rules.BUCKETS for x in h + [xx_pair(a, b) for a, b in zip(h, h[1:])]]
        grams.append(g)
        for x in g:
            raw[x] += 1
            trust[x] += bool(i in good and all(good[i]))
    n, t = sum(raw), sum(trust)
    out = []
    for (i, text, *_), g in zip(rows, grams):
        w, text = ws(text), text or ""
        seen, dup = set(), 0
        for line in text.split("\n"):
            dup += bool(ws(line)) and line in seen
            seen.add(line)
        windows = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        hit = {p for j, x in enumerate(windows) if windows.count(x) > 1 for p in range(j, j + 5)} if len(w) < 1000 else set()
        failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        mine = bool(i in good and all(good[i]))
        share = (t - len(g) * mine) / max(n - len(g), 1)
        score = 0
        for x, c in Counter(g).items():  # a document's own n-grams are left out of both multinomials
            ratio = (trust[x] - c * mine + quality_rules.PRIOR) / (share * (raw[x] - c) + quality_rules.PRIOR)
            score += c * math.floor(math.log(ratio) * quality_rules.SCALE + 0.5)
        kept = not failed and score >= len(g) * math.floor(quality_rules.THRESHOLD * quality_rules.SCALE)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed, kept, score))
    return sorted(out, key=repr)


def test_quality_rules(spark, docs, empty):
    rows = fixture()
    labels = [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(40)] + [(5, None, 1), (None, 1, 0), (6, 1, None)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_rules.judged(docs.drop("n_words"), lab)
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "gram_score")
    want = quality(rows, labels)
    assert rows_of(got, *cols) == want
    kept = quality_rules.kept_only(docs, lab)
    assert kept.columns == docs.columns and sorted((r[0] for r in want if r[7]), key=repr) == [r[0] for r in rows_of(kept, "doc_id")]
    assert quality_rules.judged(empty.drop("n_words"), lab.limit(0)).count() == 0


def test_repeated_windows(spark, empty):
    text = "a b c d e x a b c d e f a b c d e y y y y y y y"
    d = spark.createDataFrame([(1, text), (2, "w " * 30)], "doc_id long, text string")
    assert rows_of(quality_rules.base_columns(d), "doc_id", "n_repeat_words") == [(1, 22), (2, 30)]


def test_kd_sharding(docs, empty):
    out = kd_sharding.kd_shards(docs, shards=16)
    rows = fixture()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=repr)
    assert rows_of(out, "doc_id", "size", "text_crc32") == want
    slots = {}
    for r in out.collect():
        slots.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    assert set(slots) <= set(range(16)) and all(sorted(s for s, _ in v) == list(range(len(v))) for v in slots.values())
    assert rows_of(kd_sharding.kd_shards(docs, shards=16), *out.columns) == rows_of(out, *out.columns)
    assert kd_sharding.kd_shards(empty, shards=4).count() == 0
    few = kd_sharding.kd_shards(docs, shards=None, target_bytes=20_000)
    assert few.agg(F.max("shard")).first()[0] == math.ceil(sum(s for _, s, _ in want) / 20_000) - 1


def tree(points, dims, shards, first=0):
    """(key of point, leaf): the same cuts, made by sorting."""
    if shards == 1:
        return [(p[:2], first) for p in points]
    if not points:
        return []
    spread = [max(p[3 + i] >> kd_sharding.TIE_BITS for p in points) - min(p[3 + i] >> kd_sharding.TIE_BITS for p in points) for i in range(dims)]
    at = 3 + max(range(dims), key=lambda i: (spread[i], -i))
    half = shards // 2
    want, below = sum(p[2] for p in points) * half / shards, 0
    by_key = {}
    for p in points:
        by_key[p[at]] = by_key.get(p[at], 0) + p[2]
    for key in sorted(by_key):
        upto = below + by_key[key]
        if upto >= want or key == max(by_key):
            cut = key if abs(upto - want) <= abs(below - want) else key - 1
            break
        below = upto
    left, right = [p for p in points if p[at] <= cut], [p for p in points if p[at] > cut]
    return tree(left, dims, half, first) + tree(right, dims, shards - half, first + half)


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_kd_tree(spark, docs, shards):
    flat = docs.select(F.col("doc_id").alias("_id"), (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("_size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"), kd_sharding.place(F.col("n_chars"), True).alias("_d0"), kd_sharding.place(F.col("source"), False).alias("_d1"), kd_sharding.place(F.octet_length("text"), True).alias("_d9"))
    dims = ["_d0", "_d1", "_d9"]
    _, points = kd_sharding.points_of(flat, flat.agg(F.sum("_size")).first()[0] / shards, dims)
    want = tree([tuple(r) for r in points.collect()], len(dims), shards)
    got = kd_sharding.kd_leaves(points, dims, shards, Scratch(spark))
    assert sorted(((r["_text"], r["_chunk"]), r["_leaf"]) for r in got.collect()) == sorted(want)


def test_kd_copies_stay_together(spark):
    """No text of less weight than a leaf lies in two shards."""
    out = kd_sharding.kd_shards(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), shards=16)
    assert out.groupBy("text_crc32", "size").agg(F.countDistinct("shard").alias("k")).filter("k > 1").count() == 0


def test_kd_balance(spark):
    r = random.Random(3)
    rows = [(i, "w" * r.randint(1, 300) if i % 3 else "same text for a third", "en", "hot" if i % 2 else f"s{i % 9}", i, "", "") for i in range(3000)]
    out = kd_sharding.kd_shards(spark.createDataFrame(rows, SCHEMA), shards=16).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    mean = sum(x["b"] for x in out) / 16
    assert len(out) == 16 and all(abs(x["b"] - mean) < 0.1 * mean for x in out)


def targets(sizes, weights=mixing.WEIGHTS, cap=mixing.CAP):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, rest = set(), sum(sizes.values())
    while True:
        left = sum(w[s] for s in order if s not in full)
        share = {s: w[s] * rest / left for s in order if s not in full} if left else {}
        over = {s for s, x in share.items() if x > cap * sizes[s]}
        if not over:
            return share | {s: cap * sizes[s] for s in full}
        full |= over
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in full)


def test_mixing(docs, empty):
    rows, sizes = fixture(), {}
    for _, t, _, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(ws(t))
    want = targets(sizes)
    out = mixing.with_copies(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["_source_size"] == sizes[r["source"]] and r["_target"] == pytest.approx(want[r["source"]])
        rate = r["_target"] / r["_source_size"] if r["_source_size"] else 0
        draw = int(hashlib.md5(f"{'null' if r['doc_id'] is None else r['doc_id']}:{mixing.SEED}".encode()).hexdigest()[:13], 16) / 2**52
        assert r["_copies"] == math.floor(rate) + (draw < rate - math.floor(rate)) and r["_copies"] <= 3
    assert mixing.mix(docs).count() == sum(r["_copies"] for r in out) and mixing.mix(docs).columns == docs.columns
    assert mixing.mix(empty).count() == 0


def base_personal(t):
    t, o = t or "", []
    o += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    o += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or pii_spans.luhn(digits)):
                o.append((kind, *m.span()))
    return o


def test_base_spans_as_written():
    r = random.Random(4)
    for alphabet in ("a.@-_1", "0123456789. -+()", "1.2@b é"):
        for _ in range(3000):
            t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
            assert sorted(pii_spans.base_spans(t)) == sorted(base_personal(t)), t
    assert pii_spans.base_spans("4111 1111 1111 1111") == [("card", 0, 19)]
    assert len(pii_spans.base_spans("1" * 200_000 + "a" * 200_000 + "@")) == 0


def test_personal_data(spark, empty):
    r = random.Random(6)
    texts = [None, "", "write to a.b@c.de or +1 (743) 555-3824"]
    for i in range(160):
        n = "".join(r.choice("0123456789") for _ in range(15))
        card = next(n + d for d in "0123456789" if pii_spans.luhn(n + d))
        token = "".join(r.choice("0123456789abcdef") for _ in range(40))
        texts += [f"pay {card} now", f"number {n}{(int(card[-1]) + 5) % 10} here", f'token = "{token}" end', f"mail x{i}@y.com, host 10.0.{i}.1 or 999.0.{i}.1"]
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows + rows[:3], SCHEMA)
    out = pii.report(d).collect()
    assert len(out) == len(rows) + 3
    kinds = ",".join(r["spans"] for r in out)
    for x in out:
        own = base_personal(texts[x["doc_id"]])
        assert x["base_sha256"] == hashlib.sha256(",".join("%s:%d:%d" % s for s in own).encode()).hexdigest()
        assert all("%s:%d:%d" % s in x["spans"].split(",") for s in own)
    assert kinds.count("secret:") >= 150
    assert pii.report(empty).count() == 0


def test_sorted_table():
    r = random.Random(2)
    ids = sorted(r.sample(range(-(10**12), 10**12), 3000)) + [10**13] * 3
    rows = [(None, b"\1\0")] + [(i, bytes(r.randrange(0, 60) * 2)) for i in ids]
    data = b"".join(x + b"\n" for x in sorted_tables.chunks(iter(rows), 2))
    t = sorted_tables.Table(data)
    assert [(sorted_tables.id_of(k), raw) for k, raw in t] == rows and len(t.blocks) > 3
    assert all(len(t.find(i)) >= 1 for i in ids[::50]) and len(t.find(10**13)) == 3 and len(t.find(None)) == 1
    assert sum(t.may_hold(sorted_tables.key_of(i)) for i in range(10**14, 10**14 + 2000)) < 60
    with pytest.raises(ValueError):
        sorted_tables.Table(data[:-5])


def test_token_tables(spark, docs, empty, tmp_path):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    extra = [(1000, "a  b\n\n c", *[None] * 5), (1001, " lead and trail ", *[None] * 5), (1002, "it's <|endoftext|> 12,5\r\nx y", *[None] * 5), (1003, "a\nb.\n\nC d\ne", *[None] * 5)]
    rows = fixture() + extra
    token_tables.write_tables(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "t"), path)
    t = Tokenizer.from_file(path)
    want, at = [], 0
    enc = [(i, [*t.encode(x or "", add_special_tokens=False).ids, 2]) for i, x, *_ in rows]
    got = token_tables.read_tables(spark, str(tmp_path / "t")).collect()
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        want.append(r["_id"])
    assert want == sorted(want, key=lambda i: (i is not None, i))
    crc = lambda x: zlib.crc32(b"".join(v.to_bytes(4, "little") for v in x))
    assert sorted(((r["_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == sorted(((i, len(x), crc(x)) for i, x in enc), key=repr)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(str(tmp_path / "t"))
    assert sorted(r["ids"] for r in token_tables.found_in(files, [3, 77777]).collect()) == sorted(x for i, x in enc if i == 3)
    token_tables.write_tables(empty, str(tmp_path / "e"), path)
    assert token_tables.read_tables(spark, str(tmp_path / "e")).count() == 0


def test_warc(spark, tmp_path):
    r = random.Random(8)
    big = "<p>" + prose(9000, r) + "é\r\n\r\nWARC/1.1\r\n</p>"
    pages = [(1, "u", None), (2, None, ""), (3, "http://x/\r\nInjected: 1", "a" * 999), (4, "u", "a" * 999), (5, "u", "b" * 1000), (9, "u", "b" * 1000), (7, "u", "b" * 1000), (8, "u", big), (10, "u", big), (11, "v", prose(9000, r)), (11, "v", "other"), (12, "w", big + "x"), (12, "w", big + "x"), (None, "n", "b" * 1000), (None, "n", "lonely")]
    d = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    warc.write_archives(d, str(tmp_path / "w"))
    got = rows_of(warc.read_archives(spark, str(tmp_path / "w")), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "whole")
    want = []
    for i, _, html in pages:
        b = (html or "").encode()
        last = max((j for j, _, h in pages if h == html and j is not None), default=None)
        seen = sum(h == html for _, _, h in pages)
        refers = last if len(b) >= 1000 and seen > 1 and last is not None and i != last else None
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if refers is not None else "response", refers, True))
    assert got == sorted(want, key=repr)
    warc.write_archives(d.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


def test_warc_broken_segments(spark):
    recs = [b + b"\r\n\r\n" for b in warc_records.page_records(1, "u", b"z" * 50_000, None, warc.DATE)]
    assert len(recs) > 3

    def parsed(parts):
        files = spark.createDataFrame([(b"".join(parts),)], "content binary")
        p = files.mapInArrow(warc.segments, "origin string, segment long, total long, headers map<string, string>, block binary")
        return warc.reassembled(p).mapInArrow(warc.joined_pages, warc.PAGE).collect()

    assert [(x["payload_bytes"], x["whole"]) for x in parsed(recs[::-1])] == [(50_000, True)]
    for broken in (recs[:-1], recs[1:], recs[:1] + recs[2:]):
        assert [(x["payload_bytes"], x["whole"]) for x in parsed(broken)] == [(None, False)]
    with pytest.raises(ValueError):
        warc_records.dechunked(b"5\r\nabc")


def clashing(df):
    """df with columns of the names that operators make, all of them with the value 'mine'."""
    names = ("_id", "_th", "spans", "items", "n_words", "word_chars", "kept", "gram_score", "_h", "sentence_ids", "licenses", "_seq", "_size", "_source", "_target", "_copies", "_copy", "gone", "c0", "c1", "_trusted", "comp", "component_id")
    return df.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit("mine").alias(n) for n in names])


def test_clashing_columns(spark, docs):
    """What passes docs through keeps its columns and values; what reports is not disturbed by them."""
    own, plain = clashing(docs), docs.drop("slot", "n_words")
    b = spark.createDataFrame(bench_rows(fixture()), "item_id long, text string").withColumns({"len": F.lit(1), "h": F.lit(2), "_words": F.lit(3)})
    lab = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    through = {
        "quality": lambda d: quality_rules.kept_only(d, lab), "near": jaccard_join.one_of_each, "clean": lambda d: decontaminate.decontaminate(d, b),
        "spans": lambda d: decontaminate.decontaminate(d, b, remove="spans"), "mix": mixing.mix,
    }
    for name, f in through.items():
        got = f(own)
        assert got.columns == own.columns, name
        assert rows_of(got, "doc_id", "text") == rows_of(f(plain), "doc_id", "text"), name
        assert got.filter(" OR ".join(f"`{c}` <> 'mine'" for c in own.columns[5:])).isEmpty(), name
    scan = license_scan.licensed(own)
    assert len(set(scan.columns)) == len(scan.columns) and rows_of(scan, "doc_id", "licenses") == rows_of(license_scan.licensed(plain), "doc_id", "licenses")
    for f in (kd_sharding.kd_shards, pii.report, decontaminate_report(b), weak_labels.classified, jaccard_join.near_duplicates):
        assert sorted(map(repr, f(own).collect())) == sorted(map(repr, f(plain).collect()))


def decontaminate_report(b):
    return lambda d: decontaminate.report(d, b)


def test_license_sentences_reachable(spark):
    """Every known sentence is found by itself, also over two lines and with other case."""
    known = [(s, i) for i, of in license_scan.SENTENCES.items() for s in of]
    rows = [(k, form(s) + ".", i) for k, (s, i) in enumerate(known) for form in (str, str.upper, lambda s: s.replace(" ", "\n", 1), lambda s: "# " + s.replace(" ", "\n# ", 2))]
    got = license_scan.licensed(spark.createDataFrame(rows, "doc_id long, text string, want string"))
    assert got.filter("NOT startswith(sentence_ids, want)").collect() == []


def test_license_scan(spark, docs, empty):
    mit = "\n".join(["Permission is hereby granted, free of charge, to any person obtaining a copy", "of this software and associated documentation files (the \"Software\"), to deal", "in the Software without restriction, including without limitation the rights", "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell", "copies of the Software, and to permit persons to whom the Software is", "furnished to do so, subject to the following conditions:", "", "The above copyright notice and this permission notice shall be included in all", "copies or substantial portions of the Software."])
    rows = [(1, "prose here.\nReleased under the MIT License."), (2, "x | y |\nLicensed under the Apache License, Version 2.0."), (3, mit), (4, "MIT is a school"), (5, None), (6, "Licensed under CC BY-NC 4.0. Released under the MIT License."), (7, "All rights reserved. " * 3), (8, "")]
    got = dict(license_scan.licensed(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", F.concat_ws("|", "sentence_ids", "licenses", "license_class")).collect())
    assert got == {1: "mit-ref|MIT|permissive", 2: "apache2-ref|Apache-2.0|permissive", 3: "mit-grant,mit-notice|MIT|permissive", 4: "||none", 5: "||none", 6: "cc-by-nc-ref,mit-ref|MIT,CC-BY-NC-4.0|permissive", 7: "reserved,reserved,reserved|LicenseRef-reserved|reserved", 8: "||none"}
    assert license_scan.licensed(docs).count() == docs.count() and license_scan.licensed(empty).count() == 0


def test_weak_labels(spark, docs, empty):
    out = weak_labels.classified(docs.drop("n_words")).collect()
    assert len(out) == docs.count() and all(r["kept"] is not None for r in out)
    assert weak_labels.classified(empty.drop("n_words")).count() == 0
    found = weak_labels.classified(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    n, right, clean, kept = found.agg(F.count("*"), F.sum((F.col("kept") == (F.col("quality") == 1)).cast("int")), F.sum("quality"), F.sum(F.when(F.col("quality") == 1, F.col("kept").cast("int")))).first()
    assert right / n > 0.95 and kept / clean > 0.95


def test_weak_label_accuracies():
    """Expectation-maximisation over patterns against the same over single documents, written out."""
    r = random.Random(12)
    docs = []
    for _ in range(400):
        good = r.random() < 0.8
        docs.append(tuple((r.choice([0, 1]) if good else -1) if r.random() < 0.7 else 0 for _ in range(4)))
    prior, odds = weak_labels.accuracies(sorted(Counter(docs).items()))
    post = [0.01 if min(v) < 0 else 0.99 for v in docs]
    for _ in range(weak_labels.ROUNDS):
        table = []
        for j in range(4):
            row = []
            for side in (lambda p: p, lambda p: 1 - p):
                c = [sum(side(p) for p, v in zip(post, docs) if v[j] == x) + weak_labels.SMOOTH for x in (-1, 0, 1)]
                row.append([math.log(x / sum(c)) for x in c])
            table.append([a - b for a, b in zip(*row)])
        share = min(max(sum(post) / len(docs), 1e-6), 1 - 1e-6)
        post = [1 / (1 + math.exp(-max(-50, min(50, math.log(share / (1 - share)) + sum(table[j][x + 1] for j, x in enumerate(v)))))) for v in docs]
    assert prior == pytest.approx(share, rel=1e-6)
    for a, b in zip(odds, table):
        assert list(a) == pytest.approx(b, rel=1e-6)


def test_weak_label_scores(spark):
    """The scorer is learnt from posteriors alone and agrees with labels that it never saw."""
    sf = "/root/testdata/sf0.001"
    out = weak_labels.classified(spark.read.parquet(f"{sf}/documents.parquet"))
    n, near = out.agg(F.count("*"), F.sum(((F.col("score") >= 0.5) == (F.col("label") >= 0.5)).cast("int"))).first()
    assert near / n > 0.9


def test_personal_data_added(spark):
    """Added spans by brute force from the scored candidates."""
    sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10**6)).limit(10**6)
    seen = {}
    keep = pii.thresholds

    def watched(cands):
        limits = keep(cands)
        for c in cands.collect():
            seen.setdefault(c["_id"], []).append((c, limits[c["kind"]]))
        return limits

    pii.thresholds = watched
    try:
        got = {r["_id"]: {(s.kind, s.start, s.end) for s in r["added"]} for r in pii.personal_data(sf).collect()}
    finally:
        pii.thresholds = keep
    for i, spans in got.items():
        ok = [(c["score"], c["end"] - c["start"], -c["start"], c["kind"], c["start"], c["end"]) for c, least in seen.get(i, []) if not c["base"] and c["score"] >= least]
        want = {x[3:] for x in ok if not any(y > x and y[4] < x[5] and y[5] > x[4] for y in ok)}
        assert spans == want
    assert sum(map(len, got.values())) > 0


def test_candidates_are_whole():
    """Generators have no caps: long secrets, local parts and numbers are proposed whole, in time that grows with the text."""
    long = "a1" * 5_000
    assert ("secret", 8, 8 + len(long)) in pii_spans.proposed(f"token = {long}")
    assert ("email", 0, 10_006) in pii_spans.proposed("x" * 10_000 + "@ab.cd")
    assert ("number", 0, 500) in pii_spans.proposed("12345" * 100)
    assert ("secret", 9, 29) in pii_spans.proposed("password=" + "abcdefghijklmnopqrst")
    assert len(pii_spans.proposed("1 " * 100_000 + "x")) <= 1
