"""Collocations, url templates and ranked search against brute force, on rows with the awkward cases."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from textlab.llm import collocations, oracles, queries, ranked_search, url_templates

SCHEMA = "doc_id bigint, text string, lang string, source string, key int, item string, term string, n int, phrase string, score int, rank int, branch string"


def texts():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeiéßЖ") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    out = [line(rng.randint(1, 120)) + rng.choice([".", "\n", " ! ", ",x;"]) + line(30) for _ in range(60)]
    out += [f"{line(5)} New York City {line(3)}, new york. a\tb  c" for _ in range(25)] + ["New York"] * 14 + ["a a a a"] * 6
    out += ["", None, " \t\n", "...", "x", line(6000), "İ 日本語 10% A_b-c 😀😀 é"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None, "und"][i % 4], "s", 1, "i", "t", 2, "p", 3, 4, "b") for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, rows[5][1], *rows[0][2:]), (None, rows[6][1], *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- collocations -----------------------------------------------------------------------------------


def phrases_by_hand(rows, longest, least, percent, best):
    counts, words_of = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", lowered(text)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            words_of[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    candidates = {}
    for (lang, phrase), a in counts.items():
        if len(phrase) > 1 and a >= least:
            cuts = [(10**6 * a * a // (counts[lang, phrase[:k]] * counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            candidates[lang, phrase] = (score, a, counts[lang, phrase[:k]], counts[lang, phrase[k:]])
    gone = set()
    for (lang, phrase), (_, a, _, _) in candidates.items():
        for n in range(2, len(phrase)):
            for i in range(len(phrase) - n + 1):
                part = (lang, phrase[i : i + n])
                if 100 * a >= percent * candidates[part][1]:
                    gone.add(part)
    out = set()
    for lang in words_of:
        kept = [(-s, -a, " ".join(p).encode(), l, r) for (own, p), (s, a, l, r) in candidates.items() if own == lang and (own, p) not in gone]
        for rank, (s, a, phrase, l, r) in enumerate(sorted(kept)[:best], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, words_of[lang], -s))
    return out


@pytest.mark.parametrize("longest,least,percent,best,bits", [(3, 10, 50, 2000, 27), (2, 5, 50, 7, 16), (4, 3, 80, 2000, 15), (5, 2, 50, 40, 15)])
def test_collocations(docs, longest, least, percent, best, bits):
    """With 2^15 bits the map says yes to many fingerprints that are not frequent; the result stays."""
    found = collocations.collocations(docs, longest=longest, least=least, inside_percent=percent, best=best, bits=bits, parts=3)
    got = [tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    want = phrases_by_hand([(r.lang, r.text) for r in docs.collect()], longest, least, percent, best)
    assert len(want) > 6 and len(got) == len(set(got)) and set(got) == want


def thue_morse(bits):
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_phrases_with_one_fingerprint_stay_apart(spark):
    """Sums mod 2^64 cannot tell a Thue-Morse word of 2048 letters from its complement."""
    one, other = thue_morse(11)
    stream = collocations.Stream.of(pa.record_batch({"text": [one, other], "lang": ["en", "en"]}))
    prints = stream.fingerprints(np.array([0, 1]), 1)
    assert prints[0] == prints[1] and one != other
    rows = [(f"{one} x",)] * 12 + [(f"{other} x",)] * 15 + [(one,)] * 3
    found = collocations.collocations(spark.createDataFrame(rows, "text string").selectExpr("text", "'en' AS lang").repartition(3))
    assert {(r.phrase, r.a, r.l, r.r) for r in found.collect()} == {(f"{one} x", 12, 15, 27), (f"{other} x", 15, 15, 27)}


def test_fingerprints_are_sent_packed(spark):
    """A slice of texts gives a row for each range of fingerprints, not one for each n-gram, and no count is lost."""
    rng = random.Random(5)
    batch = pa.record_batch({"text": [" ".join(str(rng.randrange(3000)) for _ in range(400)) for _ in range(50)], "lang": ["en", None] * 25})
    shared = spark.sparkContext.broadcast({0: None})
    rows = list(collocations._counted(1, shared, 16)([batch]))
    stream = collocations.Stream.of(batch)
    found = collections.Counter(stream.fingerprints(stream.grams(1), 1).tolist())
    assert sum(r.num_rows for r in rows) <= 16 < len(found)
    again = pa.Table.from_batches(rows * 3).sort_by("bucket").combine_chunks().to_batches(max_chunksize=5)
    for least in (1, 10, 30):
        kept = [np.uint64(x & (2**64 - 1)) for r in collocations._frequent(least)(again) for x in r.column(0).to_pylist()]
        assert sorted(kept) == sorted(f for f, n in found.items() if 3 * n >= least)


def test_a_task_holds_a_bit_map_in_bits():
    import tracemalloc

    blocks = np.repeat(np.arange(2048), 4)
    places = np.tile(np.array([0, 7, 8, 32767]), 2048)
    batches = [pa.record_batch({"block": blocks, "place": places.astype(np.int32)})] * 2
    tracemalloc.start()
    rows = list(collocations._packed_blocks(iter(batches)))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 32 << 20  # 2^26 bits are 8 MB
    want = np.zeros(1 << 15, bool)
    want[[0, 7, 8, 32767]] = True
    assert len(rows) == 2048 and all(r.column("bits")[0].as_py() == np.packbits(want, bitorder="little").tobytes() for r in rows)


def test_collocation_scores_pass_64_bits(spark):
    rows = [("en", 0, "", 10**14), ("en", 1, "a", 3 * 10**12), ("en", 1, "b", 7 * 10**12), ("en", 2, "a b", 2 * 10**12 + 1)]
    found = collocations.scored(spark.createDataFrame(rows, "lang string, words int, phrase string, f bigint")).first()
    assert found.score == 10**6 * (2 * 10**12 + 1) ** 2 // (21 * 10**24)


# --- url templates ----------------------------------------------------------------------------------


def urls():
    rng = random.Random(3)
    out = []
    for i in range(900):
        host = rng.choice(["A.example.com", "www.example.com", "b.example.net", "c.example.org", "d.org", "net", "xnet", f"h{i % 60}.net"])
        tail = rng.choice(["", "/", ".html", "?p=/es/", "#x/y", "/a/b/c/d/e/f/g", f"/{rng.randint(1, 9)}/x{i}"])
        out.append(f"http{rng.choice(['', 's'])}://{host}/{rng.choice(['en', 'es', 'fr', 'De', 'shop'])}/{rng.randint(1, 300)}{tail}")
    out += [None, "", "no scheme", "http://", "x://EXAMPLE.com", "x://example.com/EN/1", "x://example.com?/en/", "x://a.b/é/ü\n5", "a://b://c/d", "x://a.b//en//5", "x://net/es/"]
    return out


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "h", "v", "t", "b", "s") for i, u in enumerate(urls())]
    rows += [rows[0], rows[0], (None, rows[1][1], *rows[1][2:])]
    return spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string, template string, branch string, segment string").repartition(4)


def in_duckdb(sql, **tables):
    connection = duckdb.connect()
    for name, frame in tables.items():
        connection.register(name, frame.toArrow())
    return connection.sql(sql)


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("growth", [url_templates.Growth(), url_templates.Growth(depth=3, least_urls=2, least_hosts=3, z=0.5, strength=1.0, limit=0.3)])
def test_url_templates(pages, growth):
    found = url_templates.judged(pages, queries.URL_RULES, growth)
    want = in_duckdb(oracles.url_templates(queries.URL_RULES, growth), pages=pages)
    assert counted(found.columns, found.collect()) == counted(want.columns, want.fetchall())


def test_url_rules_by_hand(pages):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    for row in url_templates.judged(pages, queries.URL_RULES).collect():
        url = next((u for i, u in enumerate(urls()) if i == row.page_id), urls()[1])
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = lowered(re.split("[/?#]", rest)[0])
            path = re.split("[?#]", rest[len(host) :])[0]
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        rule = max(fits, key=lambda r: len(r[0] + r[1])) if fits else None
        assert (row.host, row.path) == (host, path) and row.rule == (rule[0] + rule[1] if rule else None)
        assert row.verdict == rule[2] if rule else row.verdict in ("allow", "block")


def test_url_templates_merge_and_reject(spark):
    """Two branches with the same share become one; a host without labels goes by its template elsewhere."""
    rows = [(f"x://a.net/es/{i}",) for i in range(50)] + [(f"x://a.net/fr/{i}",) for i in range(50)] + [(f"x://b.com/de/{i}",) for i in range(50)]
    rows += [(f"x://c.org/{lang}/{i}",) for lang in ("es", "de") for i in range(50)]
    found = url_templates.judged(spark.createDataFrame(rows, "url string").selectExpr("hash(url) AS page_id", "url"), queries.URL_RULES)
    got = {(r.host, r.path.split("/")[1], r.template, r.verdict) for r in found.collect()}
    assert got == {
        ("a.net", "es", "/#{es|fr}/#n", "block"), ("a.net", "fr", "/#{es|fr}/#n", "block"), ("b.com", "de", "/de/#n", "allow"),
        ("c.org", "es", "/es/#n", "block"), ("c.org", "de", "/de/#n", "allow"),
    }


# --- ranked search ----------------------------------------------------------------------------------


def ranks_by_hand(rows, asked, k):
    find = lambda text: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered(text))
    docs = [(key, collections.Counter(find(text))) for key, text in rows]
    docs = [(key, terms, sum(terms.values())) for key, terms in docs if terms]
    n, total = len(docs), sum(d[2] for d in docs)
    df = collections.Counter(t for _, terms, _ in docs for t in terms)
    items = collections.defaultdict(set)
    for item, text in asked:
        items[item] |= set(find(text))
    out = []
    for item, terms in items.items():
        scores = []
        for key, counts, size in docs:
            m = 100 - 50 + (50 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m)) for t in terms if counts[t])
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def asked(spark):
    rng = random.Random(5)
    words = [w for t in texts()[:40] for w in t.split()]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40))), "t", 1) for i in range(30)]
    rows += [(100, "", "t", 1), (101, None, "t", 1), (102, "nowherefound", "t", 1), (103, "New YORK", "t", 1), (103, "x", "t", 1), (103, "x", "t", 1), (None, "City", "t", 1)]
    return spark.createDataFrame(rows, "item_id bigint, text string, term string, rank int")


@pytest.mark.parametrize("k,columns,block,size", [(50, 4096, 1024, 64 << 20), (3, 5, 7, 400), (1, 1, 1, 64 << 20)])
def test_ranked_search(docs, asked, k, columns, block, size):
    """Narrow tiles, small blocks and several passes change nothing."""
    found = ranked_search.top_documents(docs, asked, k=k, columns=columns, block=block, vocabulary_bytes=size)
    got = [tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()]
    want = ranks_by_hand([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in asked.collect()], k)
    assert want and collections.Counter(got) == collections.Counter(want)


# --- all three --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def folder(docs, pages, asked, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    pages.write.parquet(f"{path}/pages.parquet")
    asked.write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name", ["op11_collocations", "op12_url_templates", "op13_ranked_search"])
def test_queries_equal_their_sql(spark, folder, name, docs, pages, asked):
    found = queries.all_queries()[name](spark, folder)
    want = in_duckdb(oracles.all_oracles()[name], documents=docs, pages=pages, benchmark=asked)
    assert counted(found.columns, found.collect()) == counted(want.columns, want.fetchall())


def test_empty_tables(spark, docs, pages, asked):
    none = lambda frame: frame.limit(0)
    assert collocations.collocations(none(docs)).count() == 0
    assert url_templates.judged(none(pages), queries.URL_RULES).count() == 0
    assert ranked_search.top_documents(none(docs), asked).count() == 0
    assert ranked_search.top_documents(docs, none(asked)).count() == 0
