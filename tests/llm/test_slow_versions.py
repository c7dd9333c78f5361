"""Language ID and quality against slow versions written out row by row, and what each kind of evidence is worth."""

import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brightwater.llm import language, quality

SF = "/root/testdata/sf0.001"


def slow_grams(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    out = []
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        if not any(48 <= x <= 57 for x in (a, b, c)):
            x = (a * 0x1F1F35 ^ b * 0x9E3779B1 ^ c * 0x85EBCA6B) & 0xFFFFFFFF
            out.append(((x ^ x >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> 16)
    return out, any(65 <= b <= 90 or 97 <= b <= 122 or b > 127 for b in (text or "").encode())


def slow_softmax(logs):
    e = [math.exp(x - max(logs)) for x in logs]
    return [x / sum(e) for x in e]


def slow_identify(rows, model):
    """(language, confidence) of rows (text, declared, host)."""
    names, k, least = model.languages, len(model.languages), language.PRIOR_PAGES
    evidence = []
    for text, _, _ in rows:
        grams, lettered = slow_grams(text)
        mean = [sum(float(model.table[g][i]) for g in grams) / max(len(grams), 1) for i in range(k)]
        good = bool(grams) and max(mean) > 0
        if not good and not (lettered and len(grams) < language.LEAST_TRIGRAMS):
            evidence.append(None)
        else:
            evidence.append([m * min(len(grams) / 3, language.TEXT_WEIGHT) if good else 0.0 for m in mean])

    def parent(host):
        labels = host.split(".")
        return ".".join(labels[1:]) if len(labels) > 2 else labels[-1]

    hosts = [None if h is None else h.lower() for _, _, h in rows]
    votes = collections.defaultdict(lambda: [0, [0.0] * k])
    for host, e in zip(hosts, evidence, strict=True):
        if e is not None:
            p = slow_softmax(e)
            for key in (("host", host), ("parent", parent(host or "")), ("all",)):
                votes[key][0] += 1
                votes[key][1] = [a + b for a, b in zip(votes[key][1], p, strict=True)]
    smooth = lambda key, base: [(votes[key][1][i] + least * base[i]) / (votes[key][0] + least) for i in range(k)]
    top = smooth(("all",), [1 / k] * k)
    out = []
    for (_, declared, _), host, e in zip(rows, hosts, evidence, strict=True):
        if e is None:
            out.append(("und", 0.0))
            continue
        prior = smooth(("host", host), smooth(("parent", parent(host or "")), top)) if ("host", host) in votes else top
        total = [a + math.log(b) for a, b in zip(e, prior, strict=True)]
        for said, chance in ((declared and declared[:2].lower(), language.DECLARED), (language.SUFFIXES.get((host or "").split(".")[-1]) if "." in (host or "") else None, language.SUFFIX)):
            if said in names:
                total = [x + math.log(chance if n == said else (1 - chance) / (k - 1)) for x, n in zip(total, names, strict=True)]
        p = slow_softmax(total)
        best = max(range(k), key=lambda i: (p[i], -i))
        out.append((names[best] if p[best] >= language.MIN_POSTERIOR else "und", p[best]))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    return language.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_language_as_the_slow_version(spark, trained):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()
    hosts = ["a.b.example.de", "b.example.de", "www.shop.fr", "x.org", "solo", None, "A.B.Example.DE", "c.shop.fr"]
    rows = [(r["text"][: (3, 12, 40, 400)[i % 4]], (r["lang"], None, "xx", "EN-us")[i // 4 % 4], hosts[i % 7 if i % 11 else 7]) for i, r in enumerate(docs)]
    rows += [(None, "de", "x.org"), ("", None, None), ("...", "fr", None), ("a", None, "b.example.de"), ("1 2 3", "en", "x.org"), ("日本語のテキスト" * 20, "en", "x.org"), ("a", None, None), ("a", None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, text string, said string, site string")
    got = language.identify(df, trained, declared=F.col("said"), host=F.col("site")).orderBy("i").collect()
    want = slow_identify(rows, trained)
    assert len({w for w, _ in want}) >= 4
    for r, (name, confidence) in zip(got, want, strict=True):
        assert r["__confidence"] == pytest.approx(confidence, abs=1e-6), rows[r["i"]]
        assert r["__lang"] == name or abs(confidence - language.MIN_POSTERIOR) < 1e-6


def test_each_kind_of_evidence_is_worth_something(spark, trained):
    """Pages of a few letters from hosts that mostly have one language: without any one kind of evidence fewer are told right."""
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 300").orderBy("doc_id").collect()]
    suffix = {"de": "de", "es": "es", "fr": "fr", "en": "uk"}
    draw, rows = np.random.default_rng(11), []
    for i, r in enumerate(docs):
        lang = r["lang"]
        if lang in suffix:
            at, host = int(draw.integers(0, 200)), sorted(suffix).index(lang) if draw.random() < 0.7 else int(draw.integers(0, 4))
            rows.append((i, lang, r["text"][at : at + int(draw.integers(3, 9))], lang if draw.random() < 0.4 else None, f"h{host}.site.{suffix[lang] if draw.random() < 0.4 else 'org'}"))
            rows.append((-i - 1, lang, r["text"][:300], None, f"h{host}.site.org"))
    df = spark.createDataFrame(rows, "i long, lang string, text string, said string, site string")

    def right(rows_, declared=None, host=None):
        out = language.identify(rows_, trained, declared=declared, host=host).where("i >= 0")
        return out.where(F.col("__lang") == F.col("lang")).count()

    said, site = F.col("said"), F.col("site")
    full = right(df, said, site)
    less = {
        "text": right(df.withColumn("text", F.when(F.col("i") < 0, F.col("text")).otherwise(F.lit("x"))), said, site),
        "declared": right(df, None, site),
        "suffix": right(df, said, F.regexp_replace("site", r"\.(de|es|fr|uk)$", ".org")),
        "host": right(df, said, F.concat(F.lit("h"), F.col("i").cast("string"), F.lit(".lone."), F.regexp_replace("site", r"^.*\.", ""))),
    }
    print("right with all evidence", full, "and without", less)
    assert full > 0.75 * (len(rows) / 2) and max(less.values()) < full


def slow_features(text):
    text = (text or "").encode()
    if not text:
        return [0.0] * len(quality.FEATURES)
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in text)
    words, lines = lower.split(), [x for x in text.split(b"\n") if x]
    raw = text.split()
    share = lambda chars: sum(b in chars for b in text) / len(text)
    marks = [share(b".,;:'\"?-()"), share(b"!"), share(b"|"), share(b"#$%&*@^~<>{}[]\\/_=+`")]
    nw, nl = len(words), len(lines)
    return [
        math.log1p(len(text)), math.log1p(nw), sum(map(len, words)) / max(nw, 1), share(range(65, 91)), share(range(48, 58)), share(b"\t\n\x0b\x0c\r "), *marks, sum(marks),
        len(set(words)) / math.sqrt(max(nw, 1)), sum(a == b for a, b in zip(words, words[1:], strict=False)) / (nw - 1) if nw > 1 else 0.0,
        sum(65 <= w[0] <= 90 for w in raw) / nw if nw else 0.0, math.log1p(nl), len(text) / max(nl, 1), 1 - len(set(lines)) / nl if nl else 0.0,
    ]


def slow_score(model, x):
    logit = model.bias
    for j, (edges, table) in enumerate(zip(model.edges, model.tables, strict=True)):
        logit += table[sum(e < x[j] for e in edges)]
    for (i, j), grid in zip(model.pairs, model.grids, strict=True):
        logit += grid[sum(e < x[i] for e in model.coarse[i])][sum(e < x[j] for e in model.coarse[j])]
    return 1 / (1 + math.exp(-logit))


def test_quality_as_the_slow_version(spark, tmp_path):
    """Features, held-out rows, look-ups and predictions of the whole query."""
    import zlib

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    odd = [(-1, None), (-2, ""), (-3, "\n\n \n"), (-4, "ONE"), (-5, "a a a\na a a\na a a"), (-6, "é日本🙂 | !!"), (None, "x y"), (-7, "a" * 3000)]
    all_docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    texts = [r["text"] for r in all_docs.collect()]
    assert np.allclose(quality.features(pa.array(texts, pa.string())), [slow_features(t) for t in texts], atol=1e-9)
    all_docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    model = quality.train(all_docs, labels)
    assert model.pairs and any(t.any() for t in model.tables)
    want = {r["doc_id"]: r["text"] for r in all_docs.collect()}
    got = quality.query(spark, str(tmp_path)).collect()
    assert len(got) == len(texts)
    for r in got:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == held and r["score"] == pytest.approx(slow_score(model, slow_features(want[r["doc_id"]])), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.3)


def test_repeated_ids_teach_quality_once(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (i + 1)) for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    once, thrice = quality.train(docs, labels), quality.train(docs.unionByName(docs).unionByName(docs), labels.unionByName(labels))
    assert once.bias == thrice.bias and all(np.array_equal(a, b) for a, b in zip(once.tables, thrice.tables, strict=True))
