"""Each operator against a brute-force version of what it should give, and on rows that could trip it."""

import collections
import gzip
import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brightwater.llm import byte_bpe, common, components, decontaminate, language, line_dedup, near_dedup, quality, queries, suffix_dedup, token_store, vector_search, web_archive
from tests import oracle

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, and further columns with names the operators use."""
    long = " ".join(f"w{i}" for i in range(30_000)) + "\nAlpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [
        (1, "one two three four five six", "en", "a", 27), (2, "one two three four five six", "en", "a", 27), (2, "one two three four five six", "en", "a", 27), (2, "something else here", None, "a", None),
        (3, None, None, None, None), (4, "", "en", None, 0), (None, "one two three four five six", "en", "b", 27), (None, None, None, "b", None), (5, long, "en", "b", None), (6, long.upper(), "de", "b", None),
        (7, "x", "fr", "b", 1), (8, "\n\n \n", "en", "c", 4), (9, "é日本🙂 \x00 |!!", "zz", "c", 9), (10, "a" * 5000, "en", "c", 5000),
    ]
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(7) for c in ("id", "count", "size", "n", "key", "value", "__host", "__lines", "hash", "host", "label", "kept", "c0")})


def brute_repeats(texts, length=400):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[s : s + length] for b in data for s in range(len(b) - length + 1))
    out = []
    for b in data:
        cover = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                cover[s : s + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((len(b), sum(cover), len(re.findall(b"\x01+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(spark):
    rows = documents(spark).orderBy("doc_id").limit(150).collect()
    base = rows[0]["text"] * 3
    texts = [r["text"] for r in rows] + [base, base, base[:399], base[:400], base[5:700], "ab" * 450, "ab" * 300 + "c", None, "", "x" * 399, "y" * 401, "é" * 300 + base[:500]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.removals(df).collect()}
    assert [found[i] for i in range(len(texts))] == brute_repeats(texts)


def test_passages_of_fifty_words(spark):
    draw = np.random.default_rng(12)
    words = lambda n: [f"w{x}" for x in draw.integers(0, 5000, n)]
    shared, texts = words(60), []
    for i in range(30):
        n = (0, 20, 35, 36, 45, 49, 50, 51, 60)[i % 9]
        texts.append(" ".join(words(40 + 7 * i) + shared[: n] + words(i % 4 * 30)))
    texts += [" ".join(words(49))] * 2 + [" ".join(words(50))] * 2 + [" ".join(words(20) * 9), None, "", "\n".join(shared[5:55]), texts[6] + " " + texts[14]]
    got = {r["id"]: r["passage"] for r in suffix_dedup.removals(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}

    def holders(n):
        seen = collections.defaultdict(set)
        for i, t in enumerate(texts):
            w = (t or "").split()
            for k in range(len(w) - n + 1):
                seen[tuple(w[k : k + n])].add(i)
        return {i for ids in seen.values() if len(ids) > 1 for i in ids}

    flagged = {i for i, x in got.items() if x}
    assert holders(50) <= flagged <= holders(36) and 0 < len(holders(50)) < len(texts) - 10
    data = [" ".join(words(n)) for n in (700, 3, 0, 90)]
    body, at = common.utf8(pa.array(data))
    whole = suffix_dedup.prints(body, at, 50, 36)
    assert [x.tolist() for x in whole] == [np.concatenate(x).tolist() for x in zip(*(((i + np.zeros(len(h), int)), h) for i, t in enumerate(data) for _, h in [suffix_dedup.prints(*common.utf8(pa.array([t])), 50, 36)]), strict=True)]


def test_suffix_dedup_splits_frequent_anchors(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SPLIT_FROM", 2)
    shared = "".join(chr(97 + i * i * 7 % 26) for i in range(450))
    texts = [f"{i} " * (3 + i) + shared[i % 3 * 20 :] + f" {i * i}" * 9 for i in range(12)] + [shared, "z" * 600]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    make, _ = suffix_dedup._stretches(400, 128, slim=False)
    found = [{"hash": 1, "place": 20 << 20 | 5 << 10 | 200, "size": 5}]
    batch = pa.RecordBatch.from_pylist([{"c1": 1, "c2": 2, "text": shared[:440] + "q" * 200, "found": found}])
    rows = pa.Table.from_batches(make(iter([batch]))).to_pylist()
    assert sum(r["owned"] for r in rows) == 196 and len({r["meet"] for r in rows}) == len(rows) > 4
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.removals(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts)


def test_suffix_dedup_of_crowds(spark, monkeypatch):
    """A passage that many contents share, with contexts that agree for a while: compared window by window."""
    monkeypatch.setattr(suffix_dedup, "SPLIT_FROM", 4)
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    shared = "".join(chr(97 + i * i * 7 % 26) for i in range(700))
    texts = [f"{i % 3} " * (3 + i % 5) + shared[i % 4 * 3 : 640 + i % 6 * 9] + f" {i % 7}" * 9 for i in range(40)] + [shared] * 3 + ["z" * 600]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, crowded = [], suffix_dedup._crowded
    monkeypatch.setattr(suffix_dedup, "_crowded", lambda stretches, length: seen.append(stretches.count()) or crowded(stretches, length))
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.removals(df).collect()}
    assert seen[0] > 20 and [got[i] for i in range(len(texts))] == brute_repeats(texts)


@pytest.mark.parametrize("kind", ["rising", "falling", "random", "star", "grid"])
def test_components_in_few_rounds(spark, kind):
    n, draw = 60, np.random.default_rng(3)
    names = {"falling": range(n, 0, -1), "random": draw.permutation(n * 10)[:n].tolist()}.get(kind, range(1, n + 1))
    names = [int(x) for x in names]
    if kind == "star":
        edges = [(names[-1], x) for x in names[:-1]]
    elif kind == "grid":
        edges = [(i, i + 1) for i in range(100) if i % 10 < 9] + [(i, i + 10) for i in range(90)]
    else:
        edges = list(zip(names, names[1:], strict=False))
    edges += [(5000, 5001), (5001, 5000), (7000, 7000), (5001, 5002), (None, 1), (5000, 5001)]
    rounds: list[int] = []
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), rounds).collect()}
    least = min(min(e) for e in edges[:-6])
    nodes = {x for e in edges[:-6] for x in e}
    assert got == dict.fromkeys(nodes, least) | dict.fromkeys((5000, 5001, 5002), 5000)
    assert len(rounds) <= (2 if kind == "star" else 12)


def test_byte_bpe_is_what_the_library_gives(spark):
    import tiktoken

    path, pattern = byte_bpe.vocabulary()
    assert pattern == byte_bpe.SPLIT_PATTERN
    own, ranks = byte_bpe.encoder(path, pattern), byte_bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    draw = np.random.default_rng(5)
    parts = ["a", " ", "  ", "\n", "é", "'s", "'", " the", "1", "23", "!!", "日", "　", "\t", "aaa", "==", "ing", "<|endoftext|>", "\x00", "🙂", "\r\n", "\x85"]
    texts = ["".join(draw.choice(parts, draw.integers(0, 25))) for _ in range(3000)] + [r["text"] for r in documents(spark).limit(40).collect()]
    texts += ["", "a" * 9001, "ab" * 5000, "é" * 4999 + " x", "\n" * 5000 + "x", "thething" * 1500]  # longer than what is looked ahead
    ids, first = own.encode(pa.array(texts))
    whole = own.parts(own.bytes_of, ids, first)
    for i, text in enumerate(texts):
        mine = ids[first[i] : first[i + 1]]
        assert mine.tolist() == library.encode_ordinary(text)
        assert b"".join(next(whole)) == text.encode()
        decoder, tokens = byte_bpe.StreamDecoder(), own.bytes_of.take(pa.array(mine[:2000])).to_pylist()
        assert "".join(map(decoder.feed, tokens)) + decoder.close() == b"".join(tokens).decode("utf-8", "replace")


def test_byte_bpe_digests_and_decodes(spark, odd):
    out = byte_bpe.encode(odd, *byte_bpe.vocabulary())
    back = byte_bpe.decode(out, *byte_bpe.vocabulary(), ids="__ids")
    rows = back.collect()
    assert len(rows) == odd.count() and set(odd.columns) < set(back.columns)
    for r in rows:
        text = r["text"] or ""
        assert r["__text"] == text and r["__n_tokens"] == len(r["__ids"]) and r["count"] == 7
        assert r["__decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["__ids_sha256"] == hashlib.sha256(",".join(map(str, r["__ids"])).encode()).hexdigest()
    lists = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "k int, ids array<int>")
    assert [r["__text"] for r in byte_bpe.decode(lists, *byte_bpe.vocabulary()).orderBy("k").collect()][:2] == [None, ""]
    with pytest.raises(ValueError, match="__tokens"):
        byte_bpe.encode(odd.withColumn("__tokens", F.lit(1)), *byte_bpe.vocabulary())


def test_byte_bpe_starts_over_when_full(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 3)
    monkeypatch.setattr(byte_bpe, "MOVES", 5)
    monkeypatch.setattr(byte_bpe, "LOOKAHEAD", 4)
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"cab": 259, b"aa": 260, b"aaaa": 261}
    own = byte_bpe.Encoder(ranks, byte_bpe.SPLIT_PATTERN)
    for text in ("abcab", "aaaaaaa", "cabab abc", "bcbcbc aab", "a b c d e f", "aaaaaaaaabcabcabababcbcbcaab"):
        assert own.encode(pa.array([text]))[0].tolist() == [t for p in own.pieces(text) for t in slow_bpe(p.encode(), ranks)]
        assert len(own.kept) <= 3


def slow_bpe(data, ranks):
    parts = [bytes([b]) for b in data]
    while True:
        best = min(((ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_utf8_machine_waits_for_the_rest():
    for text in ("é", "日", "🙂", "a"):
        data = text.encode()
        for i in range(len(data) + 1):
            assert byte_bpe.Utf8Machine.waiting(data[:i]) == (i if i < len(data) else 0)
    assert byte_bpe.Utf8Machine.waiting(b"\xed\xa0") == 0 and byte_bpe.Utf8Machine.waiting(b"\xff") == 0


def brute_benchmark(texts, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for name, text in items:
        w = words(text)
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[j : j + k])].add(name)
    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if (key := tuple(w[j : j + k])) in windows:
                    names |= {str(x) for x in windows[key] if x is not None}
                    hit |= set(range(j, j + k))
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()))
    return out


def test_decontaminate(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "the of"), (901, ""), (902, None), (None, "and the"), (900, "the of"), (903, "A b C d e f g h i j k")]
    texts = [r["text"] for r in documents(spark).orderBy("doc_id").collect()] + [None, "", "THE, of!", "and\nthe of the of", "a b c d e f g h i j", "b c d e f g h i j k", items[0][1], f"x {items[3][1]} {items[0][1]} y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate.annotate(df, spark.createDataFrame(items, "item_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r)[2:6] for r in got] == brute_benchmark(texts, items)
    both = f"{items[3][1]} {items[0][1]}"
    words = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(both)))
    assert got[-1]["__clean"] == f"x {both[: words[0].start()]}{both[words[-1].end() :]} y" and got[-1]["__clean"] != got[-1]["text"]
    for r in got:
        if r["text"] is not None:
            assert brute_benchmark([r["__clean"]], [i for i in items if i[1] and len(i[1]) > 60])[0][1] == 0


def test_decontaminate_reads_a_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    df = documents(spark).select("doc_id", "text").limit(60)
    assert len(decontaminate.benchmark_blocks(items)) > 3
    got = decontaminate.annotate(df, items, clean=False).orderBy("doc_id").collect()
    assert [tuple(r)[2:6] for r in got] == brute_benchmark([r["text"] for r in got], [tuple(r) for r in items.collect()])


def brute_near(rows, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [(rows[i][0], len(s), rows[find(i)][0], find(i) == i) for i, s in enumerate(sets)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_dedup(spark, percent):
    texts = [r["text"] for r in documents(spark).orderBy("doc_id").limit(120).collect()]
    draw, words = np.random.default_rng(3), " ".join(texts[:3]).split()[:150]
    for edits in range(60):  # a family whose members' similarity spans the threshold
        own = list(words)
        for i in draw.integers(0, len(own), draw.integers(0, 9)):
            own[i] = words[draw.integers(0, 20)] + str(draw.integers(0, 3))
        texts.append(" ".join(own))
    texts += [None, "", " \n", "a b", "A  b", "a b c d e", "a b c d e f", texts[5], texts[5]]
    rows = list(enumerate(texts))
    got = near_dedup.mark(spark.createDataFrame(rows, "doc_id long, text string"), percent).orderBy("id").collect()
    assert [tuple(r) for r in got] == brute_near(rows, percent)


def test_signatures_agree_as_often_as_sets_are_similar():
    signer, draw = near_dedup.Signer(80), np.random.default_rng(1)
    same = []
    for _ in range(60):
        both, a, b = (draw.integers(0, 2**64, n, np.uint64) for n in (80, 10, 10))
        same.append(np.mean([np.concatenate(x) for x in zip(*(np.equal(p, q)[None] for p, q in zip(signer.values(np.concatenate([both, a])), signer.values(np.concatenate([both, b])), strict=True)), strict=True)]))
    assert abs(np.mean(same) - 0.8) < 0.03
    assert (1 - 0.8**4) ** near_dedup.bands(80) < 1e-5 and (1 - 0.85**4) ** near_dedup.bands(85) < 1e-5


def test_arc_of_both_versions():
    for version in (1, 2):
        body = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n<p>x</p>\n\n"
        data = web_archive.arc_head(version, "a.arc") + web_archive.arc_record(version, "http://a b/c d", body, "20010203040506") + web_archive.arc_record(version, "dns:a", b"1.2.3.4", "2001")
        info, page, dns = (web_archive.to_warc(r, "a.arc") for r in web_archive.read_arc(iter([data])))
        assert (info.kind, page.kind, dns.kind) == ("warcinfo", "response", "resource")
        assert page.fields["WARC-Target-URI"] == "http://a b/c d" and page.fields["WARC-Date"] == "2001-02-03T04:05:06Z" and page.block == body
        assert page.fields["WARC-Payload-Digest"] == web_archive.sha1_label(b"<p>x</p>\n\n") and dns.fields["WARC-Date"] == "2001-01-01T00:00:00Z"
        zipped = b"".join(gzip.compress(x) for x in (data[:50], data[50:]))
        again = [web_archive.to_warc(r, "a.arc").fields["WARC-Record-ID"] for r in web_archive.read_arc(web_archive.inflated(zipped[i : i + 7] for i in range(0, len(zipped), 7)))]
        assert again == [r.fields["WARC-Record-ID"] for r in (info, page, dns)] and len(set(again)) == 3
        with pytest.raises(web_archive.ArchiveError):
            list(web_archive.read_arc(iter([data[:-6]])))
    with pytest.raises(web_archive.ArchiveError):
        list(web_archive.read_arc(iter([b"http://a 1 2 3 4\nabcd\n"])))
    with pytest.raises(web_archive.ArchiveError):
        list(web_archive.inflated(iter([zipped[:-3]])))


def test_pages_come_back_from_archives(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a/x y\n", big), (2, None, big), (3, "http://b", None), (4, "http://c", "small"), (5, "http://c", "small"), (5, "http://c", "small"), (None, "http://d", big), (None, "http://e", "z"), (9, "http://f", "a" * 999)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = web_archive.read(web_archive.write(web_archive.roles(pages), str(tmp_path / "w"))).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got if r["page_id"] is not None}
    assert (by[1]["record_type"], by[1]["refers_to"], by[1]["payload_bytes"], by[2]["record_type"]) == ("revisit", 2, 1200, "response")
    assert by[1]["payload_digest"] == hashlib.sha1(big.encode()).hexdigest() and bytes(by[2]["payload"]) == big.encode() and by[2]["url"] == "urn:page:2"
    assert {(r["record_type"], r["refers_to"]) for r in got if r["page_id"] is None} == {("revisit", 2), ("response", None)}
    assert web_archive.read(web_archive.write(web_archive.roles(pages.limit(0)), str(tmp_path / "e"))).count() == 0


def test_arc_files_hold_many_records(spark, tmp_path):
    draw = np.random.default_rng(4)
    rows = [(i, f"http://h/{i}", draw.bytes(400).hex() + "x" * (i % 4 * 300) if i % 5 else "same " * 300) for i in range(60)]
    pages = web_archive.roles(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2))
    arcs = web_archive.write_arc(pages, str(tmp_path / "arc"), file_bytes=3000)
    there = arcs.collect()
    assert sum(r["records"] for r in there) == 60 and 4 < len(there) < 30 and sum(len(r["revisits"]) for r in there) == 11
    versions = set()
    for r in there:
        records = list(web_archive.read_arc(web_archive._pieces(r["file"])))
        versions.add(records[0].version)
        assert len(records) == r["records"] + 1 and records[0].fields["URL"].startswith("filedesc://")
    assert versions == {1, 2}
    files = web_archive.convert(arcs, str(tmp_path / "warc"), file_bytes=2500)
    for r in files.collect():
        kinds = [x.kind for x in web_archive.read_warc(web_archive._pieces(r["file"]))]
        assert kinds[0] == "warcinfo" and len(kinds) == r["records"] + 1
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["url"], r["payload_digest"]) for r in web_archive.read(files).collect()}
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    assert got == {i: ("response" if i % 5 or i == 55 else "revisit", None if i % 5 or i == 55 else 55, u, sha(t)) for i, u, t in rows}


def test_archive_query_as_sql_on_equal_payloads(spark, tmp_path):
    """The driver's pages hold no equal payloads; these do, about the least size, with null and repeated ids."""
    large, small, edge = "é" * 700, "s" * 999, "e" * 1000
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate([large, small, edge, large, small, edge, None, None, "", large, "x" * 5000])]
    rows += [(None, "http://n", large), (None, "http://n", None), (None, None, edge), (-4, "http://m", large)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.QUERIES["op5_web_archive"](spark, str(tmp_path))
    assert oracle.differences(got, queries.ORACLE_SQL["op5_web_archive"], str(tmp_path)) == ""
    assert got.where("record_type = 'revisit'").count() == 6


def brute_top(rows, queries_, k):
    usable = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, e in usable:
        if queries_(q):
            near = sorted((-int(e @ f), i) for i, f in usable if i != q and len(f) == len(e))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 4096])
def test_vector_search(spark, monkeypatch, block):
    monkeypatch.setattr(vector_search, "BLOCK", block)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 3)
    draw = np.random.default_rng(9)
    rows = [(i, draw.normal(size=8).astype(float).tolist()) for i in range(90)] + [(100 + i, [0.5] * 8) for i in range(20)]
    rows += [(200, None), (201, [None] * 8), (202, [float("nan")] * 8), (203, [float("inf")] + [0.0] * 7), (None, [0.1] * 8), (204, []), (205, [1.0, 2.0]), (210, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vector_search.search(df, df.where("vec_id % 5 = 0"), k=7)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, lambda i: i % 5 == 0, 7)


def test_bounds_hold():
    draw = np.random.default_rng(2)
    block = vector_search.Approximation(np.arange(500), draw.integers(-2000, 2000, (500, 16)))
    q = draw.integers(-2000, 2000, (20, 16))
    low, gap = block.bounds(q)
    exact = q @ block.values.T
    assert (low <= exact).all() and (exact <= low + gap[:, None]).all() and gap.max() < 0.05 * np.abs(exact).max() * 16


def test_token_store(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [r["text"] for r in documents(spark).limit(60).collect()] + [None, "", "  ", "İΣ ΑΣ é <|endoftext|> Ab'S 12²3 日本　x", "the " * 40_000]
    df = spark.createDataFrame([(3 * i % 97, t) for i, t in enumerate(texts)], "doc_id long, text string")
    files, table = token_store.store(df, path, str(tmp_path / "t"))
    got = token_store.read(files, table, ids=True).orderBy("doc_id").collect()
    start = 0
    for r, (key, text) in zip(got, sorted(df.collect()), strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (key, start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_token_files_notice_damage():
    draw = np.random.default_rng(4)
    ids = np.minimum(draw.zipf(1.3, 200_000), 60_000).astype(np.uint32)
    table = token_store.Table(np.bincount(ids, minlength=60_001))
    assert int(table.freq.sum()) == 1 << table.bits and (table.freq[np.unique(ids)] > 0).all()
    data = token_store.pack(ids, [1, None, 3], [5, 0, len(ids) - 5], table)
    back, keys, lengths = token_store.unpack(data, table)
    assert (back == ids).all() and keys == [1, None, 3] and list(lengths) == [5, 0, len(ids) - 5] and len(data) < 2 * len(ids)
    assert [len(x) for x in token_store.iterate(data, table)] == list(lengths)
    for at in (0, 40, len(data) // 2, len(data) - 20):
        with pytest.raises(token_store.TokenFileError):
            token_store.unpack(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :], table)
    with pytest.raises(token_store.TokenFileError):
        token_store.encode_blocks(np.array([59_999_999]), table)
    for n in (1, 2, 511, 65_536, 65_537):
        assert (token_store.decode_blocks(token_store.encode_blocks(ids[:n], table), [65_536] * (n // 65_536) + [n % 65_536] * (n % 65_536 > 0), table) == ids[:n]).all()


def test_language_by_text_alone_on_held_out_rows(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = language.train(docs)
    held = docs.where((F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & (F.length("text") > 40))
    got = language.identify(held, model).select("lang", "__lang").collect()
    assert np.mean([r[0] == r[1] for r in got]) > 0.97 and len(got) > 100


def test_language_evidence_adds_up(spark):
    docs = documents(spark)
    model = language.train(docs)
    rows = [("", "http://x.example.de/", None), ("the of", "http://en.example.com/", "de"), ("le de la", "http://a.fr/", None), ("qxzj 0000", "http://b.es/", "es")]
    pages = spark.createDataFrame([(f'<html lang="{d}"><p>' if d else "<html>", t, u) for t, u, d in rows], "html string, text string, url string")
    got = language.identify(pages, model, declared=language.markup_language(F.col("html")), host=language.address_host(F.col("url"))).collect()
    assert [r["__accepted"] for r in got][0] is False and got[2]["__lang"] == "fr"
    assert language.markup_language(F.lit("<HTML LANG='FR-ca'>")) is not None
    assert spark.range(1).select(language.markup_language(F.lit("<HTML LANG='FR-ca'>")), language.address_host(F.lit("HTTP://u@A.b:80/x"))).first()[:] == ("fr", "a.b")


def test_pages_have_their_declared_language(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("text", F.regexp_replace(F.regexp_replace("html", "(?s)<(script|style).*?</", " "), "<[^>]*>", " "))
    model = language.train(documents(spark))
    got = language.identify(pages, model, declared=language.markup_language(F.col("html")), host=language.address_host(F.col("url")))
    assert got.where(F.col("__lang") == language.markup_language(F.col("html"))).count() > 0.95 * pages.count()


def test_all_evidence_acts_in_the_query_of_pages(spark, tmp_path):
    """Texts of two letters tell nothing, so suffix, declaration, host or parent domain decide."""
    import __spark_entry__

    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    german, english = (documents(spark).where(f"lang = '{x}' AND length(text) > 200").select("text").first()[0] for x in ("de", "en"))
    rows = [(1, "http://a.b.fr/", "<p>xq"), (2, "http://a.example.com/", "<html lang='es'><p>xq"), (3, "http://new.shop.example.net/", "<p>xq"), (4, "http://x.y.org/", "<p>"), (5, None, None), (6, "http://new.lone.example.org/", "<p>xq")]
    rows += [(10 + i, "http://old.shop.example.net/", f"<!-- x --><script>var the = 'the of and';</script><p>{german} &uuml;ber</p>") for i in range(14)]
    rows += [(40 + i, "http://old.club.example.com/", f"<p>{english}</p>") for i in range(18)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r for r in __spark_entry__.queries()["op9_language_of_pages"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) and (got[1]["language"], got[2]["language"], got[3]["language"], got[10]["language"]) == ("fr", "es", "de", "de")
    assert got[40]["language"] == "en" and not any(got[i]["accepted"] for i in (4, 5, 6))


def test_text_of_markup(spark):
    rows = ["<!-- a > b --><STYLE>x</style>A&ntilde;o<br>n", "x<script>never closed", "", None]
    out = spark.createDataFrame([(r,) for r in rows], "html string").select(language.markup_text(F.col("html"))).collect()
    assert [r[0] and r[0].split() for r in out] == [["Año", "n"], ["x"], "", None]


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    out = quality.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    bad, good = out[out.quality == 0].score.to_numpy(), out[out.quality == 1].score.to_numpy()
    auc = (good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2
    print("auc", auc, "accuracy", (out.predicted == out.quality).mean())
    assert auc > 0.95 and (out.predicted == out.quality).mean() > 0.9


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    assert quality.score(docs, quality.train(docs, none)).first()["__score"] == 0.5


def test_additive_model_finds_an_interaction():
    draw = np.random.default_rng(8)
    x = draw.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.AdditiveModel(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.95


def test_line_dedup_keeps_small_hosts(spark):
    rows = [(i, "head\nbody %d\n\nfoot" % i, "h") for i in range(4)] + [(9, "head\nx", "other"), (10, None, None), (11, "", "h")]
    got = {r["doc_id"]: (r["text"], r["__n_lines"], r["__n_dropped"]) for r in line_dedup.cut_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {**{i: (f"body {i}\n", 4, 2) for i in range(4)}, 9: ("head\nx", 2, 0), 10: (None, 0, 0), 11: ("", 1, 0)}


def test_pipeline_keeps_one_of_many_copies(spark):
    copy = "menu\n" + "\n".join(" ".join(f"w{i}x{k}" for k in range(8)) for i in range(3))
    rows = [(i, copy, "en", "h", None) for i in range(20)] + [(i, f"menu\nbody of {i} is this", "en", "h", None) for i in range(20, 60)]
    docs = corpus_pipeline.line_stage(spark, spark.createDataFrame(rows, DOCS), SF)
    cut = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert cut == {i: t.removeprefix("menu\n") for i, t, *_ in rows}
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.near_stage(spark, docs, SF).collect()}
    assert left == {i: t for i, t in cut.items() if i == 0 or i >= 20}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    assert oracle.differences(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name], SF) == ""


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def run_all(spark, docs, folder):
    """What every operator gives for docs, as the number of its rows."""
    import public_tokenizers

    common.prepare(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (5, None)], "doc_id long, quality int")
    vectors = docs.select(F.col("doc_id").alias("vec_id"), F.array(F.length("text").cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    items = spark.createDataFrame([(1, "one two three four"), (2, None), (None, "x")], "item_id long, text string")
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))
    files, table = token_store.store(docs, public_tokenizers.path("word_bpe_49k.json"), f"{folder}/tokens")
    return {
        1: suffix_dedup.removals(docs, keep_text=True).count(), 2: byte_bpe.encode(docs, *byte_bpe.vocabulary()).select("__ids").collect().__len__(), 3: len(decontaminate.annotate(docs, items).collect()),
        4: near_dedup.mark(docs).count(), 5: web_archive.read(web_archive.write(web_archive.roles(pages), f"{folder}/warc")).count(), 7: token_store.read(files, table).count(),
        8: len(line_dedup.cut_lines(docs).collect()), 9: len(language.documents(docs).collect()), 10: len(quality.score(docs, quality.train(docs, labels)).collect()),
        6: vector_search.search(vectors, vectors).select("vec_id").distinct().count(),
    }


def test_odd_rows_pass_through_everything(spark, odd, tmp_path):
    found = run_all(spark, odd, tmp_path)
    # Vectors take part if they have an id and a length; each is among the ten best of some other.
    assert found.pop(6) == odd.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").distinct().count()
    assert set(found.values()) == {odd.count()}


def test_odd_rows_have_right_values(spark, odd, tmp_path):
    """Null and repeated ids, null texts, repeated rows, and columns named like those that operators use inside."""
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    count = collections.Counter
    got = count((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.removals(odd).collect())
    assert got == count((i, *x) for i, x in zip(ids, brute_repeats(texts), strict=True))
    items = [(1, "one two three four"), (2, None), (None, "x"), (3, "日本 a")]
    clean = decontaminate.annotate(odd, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = count((r["doc_id"], r["__n_words"], r["__n_hit"], r["__n_items"], r["__items_sha256"]) for r in clean)
    assert got == count((i, *x) for i, x in zip(ids, brute_benchmark(texts, items), strict=True))
    assert {(r["text"], r["__clean"]) for r in clean if r["text"] in (None, "", "x", texts[0])} == {(None, None), ("", ""), ("x", ""), (texts[0], " five six")}
    # Of rows with an id, those with equal ids are one node; rows without one are linked with nothing.
    got = count((r["id"], r["n"], r["component"], r["kept"]) for r in near_dedup.mark(odd).collect())
    sets = [x[1] for x in brute_near(list(enumerate(texts)), 80)]
    components_ = {None: None, 2: 1, 6: 5}
    assert got == count((i, n, components_.get(i, i), components_.get(i, i) == i) for i, n in zip(ids, sets, strict=True))
    hosts = collections.defaultdict(list)
    for _, text, host in rows:
        hosts[host].append(text)
    want = count()
    for i, text, host in rows:
        lines = [] if text is None else text.split("\n")
        holds = {x: sum(t is not None and x in t.split("\n") for t in hosts[host]) for x in lines}
        kept = [x for x in lines if not x.strip() or holds[x] < line_dedup.MIN_PAGES or holds[x] <= line_dedup.MAX_RATIO * len(hosts[host])]
        want[i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    assert count((r["doc_id"], r["text"], r["__n_lines"], r["__n_dropped"]) for r in line_dedup.cut_lines(odd).collect()) == want
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    files, table = token_store.store(odd, path, str(tmp_path / "t"))
    got = count((r["doc_id"], tuple(r["ids"])) for r in token_store.read(files, table, ids=True).collect())
    assert got == count((i, (*library.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in zip(ids, texts, strict=True))
    for name, act in (("__score", lambda d: quality.score(d, quality.AdditiveModel(np.empty((0, 17)), np.empty(0)))), ("__clean", lambda d: decontaminate.annotate(d, spark.createDataFrame(items, "item_id long, text string"))), ("__n_lines", line_dedup.cut_lines), ("__LANG", language.documents)):
        with pytest.raises(ValueError, match="are there already"):
            act(odd.withColumn(name, F.lit(1)))


def test_empty_tables(spark, odd, tmp_path):
    assert set(run_all(spark, odd.limit(0), tmp_path).values()) == {0}


def test_stages_on_odd_rows(spark, odd, tmp_path):
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
            docs = out
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_pipeline_against_brute_force(spark, tmp_path):
    """The stages' decisions on the smallest tables, from simple versions of each operator."""
    docs = [r.asDict() for r in documents(spark).collect()]
    stages = [documents(spark)]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, stages[-1], SF).write.parquet(str(tmp_path / str(i)))
        stages.append(spark.read.parquet(str(tmp_path / str(i))))
    kept = [r.asDict() for r in stages[1].collect()]
    assert len(kept) >= 0.99 * len(docs)
    hosts = collections.defaultdict(list)
    for r in kept:
        hosts[r["source"]].append(set(r["text"].split("\n")))
    for r in kept:
        own = hosts[r["source"]]
        bad = {x for x in set(r["text"].split("\n")) if x.strip() and (n := sum(x in p for p in own)) >= line_dedup.MIN_PAGES and n > line_dedup.MAX_RATIO * len(own)}
        r["text"] = "\n".join(x for x in r["text"].split("\n") if x not in bad)
    assert {(r["doc_id"], r["text"]) for r in stages[2].collect()} == {(r["doc_id"], r["text"]) for r in kept}
    rows = sorted((r["doc_id"], r["text"]) for r in kept)
    stay = {x[0] for x in brute_near(rows, near_dedup.PERCENT) if x[3]}
    assert {r["doc_id"] for r in stages[3].collect()} == stay
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    after = {r["doc_id"]: r for r in stages[4].collect()}
    assert set(after) == stay and all(r["n_chars"] == len(r["text"]) for r in after.values())
    for key, text in rows:
        if key in stay and brute_benchmark([text], items)[0][1] == 0:
            assert after[key]["text"] == text
    own = byte_bpe.encoder(*byte_bpe.vocabulary())
    assert {(r["doc_id"], tuple(r["ids"])) for r in stages[5].collect()} == {(k, tuple(own.encode(pa.array([r["text"]]))[0].tolist())) for k, r in after.items()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[5].collect()))
