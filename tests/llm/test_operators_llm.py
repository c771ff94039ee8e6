"""The operators of the llm subpackage against brute force and on odd rows."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import chat, decontaminate, html_main, mixing, quality, simhash, token_counts, topk, toxicity, urls
from shelfmark.llm.common import fold, labelled_sample, table
from shelfmark.llm.components import components
from shelfmark.llm.queries import QUERIES
from shelfmark.session import scratch_path

SF = "/root/testdata/sf0.001"
ODD = [
    (1, "a b c d e f", "en", "s1", "x"),
    (1, "a b c d e f", "en", "s1", "x"),
    (2, None, None, None, None),
    (3, "", "en", "s1", "y"),
    (4, " \t\n", "de", "", "z"),
    (None, "lone words without any number at all here", None, "s2", None),
    (5, "wort " * 30_000, "de", "s2", "long"),
]
DOCS = "doc_id long, text string, lang string, source string, score string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- mixing ----------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if level * weight[n] >= cap * sizes[n]}
        if not full:
            return target | {n: level * weight[n] for n in open_}
        for n in full:
            target[n] = float(cap * sizes[n])
            left -= cap * sizes[n]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_cut(spark, seed):
    draw = random.Random(seed)
    rows = [
        (i, " ".join("w" * draw.randint(1, 3) for _ in range(draw.randint(0, 30))), None, draw.choice(["a", "b", "c", "é", None]), None)
        for i in range(300)
    ]
    rows = [r for r in rows if r[3] != "b" or draw.random() < 0.1]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r.target == pytest.approx(want[r.source])
        assert r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) < 1.001
    again = mixing.mix(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mixed_texts(spark, odd, empty):
    mixed = mixing.mixed_texts(odd)
    assert mixed.columns == ["doc_id", "lang", "source", "score", "text", "epoch", "taken"]
    plan = mixing.mix(odd)
    assert mixed.agg(F.sum("taken")).first()[0] == plan.agg(F.sum("taken")).first()[0]
    assert mixed.where(mixing.word_count(F.col("text")) != F.col("taken")).count() == 0
    assert plan.count() == len(ODD)
    assert mixing.mixed_texts(empty).count() == 0


# --- classifiers -----------------------------------------------------------------


def test_toxicity_edges_and_accuracy(spark, odd, empty):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.fit_toxicity(docs, labels, fold(F.col("doc_id"), 4) != 2)
    scored = toxicity.with_toxicity(docs.select("doc_id", "text"), model).join(labels, "doc_id")
    rows = scored.where(fold(F.col("doc_id"), 4) == 2).select("score", "toxic").toPandas()
    pos, neg = rows[rows.toxic == 1].score.to_numpy(), rows[rows.toxic == 0].score.to_numpy()
    assert (pos[:, None] > neg[None, :]).mean() > 0.94
    assert (pos >= 0.3).mean() > 0.65 and (neg >= 0.3).mean() < 0.01
    out = toxicity.with_toxicity(odd, model)
    assert out.columns == odd.columns and out.count() == len(ODD)
    assert out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.with_toxicity(empty, model).count() == 0


def test_classifiers_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    toxic = toxicity.fit_toxicity(odd, none, F.lit(True))
    good = quality.fit_quality(odd, none, F.lit(True))
    assert {r.score for r in toxicity.with_toxicity(odd, toxic).collect()} == {0.5}
    assert {r.score for r in quality.with_quality(odd, good).collect()} == {0.5}


def test_grams_of_pieces_are_those_of_the_whole(monkeypatch):
    import pandas as pd

    texts = pd.Series(["abcdefghij" * 7, None, "", "xyz", "some other words of a text"])
    every = np.ones(toxicity.FEATURES, dtype=bool)
    whole = toxicity.active(texts, every)
    monkeypatch.setattr(toxicity, "PIECE", 16)
    for run in (toxicity.RUN, 20):
        monkeypatch.setattr(toxicity, "RUN", run)
        parts = toxicity.active(texts, every)
        assert all((a == b).all() for a, b in zip(whole, parts))


def test_features_count_occurrences():
    import pandas as pd

    number, feature = toxicity.active(pd.Series(["word", "word word word word word word"]), np.ones(toxicity.FEATURES, dtype=bool))
    levels = feature >> toxicity.BITS
    assert set(levels[number == 0]) == {0} and set(levels[number == 1]) == set(range(toxicity.LEVELS))
    assert set(feature[number == 0]) < set(feature[number == 1])


def test_quality_accuracy_and_compiled_rules(spark, odd, empty):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = quality.fit_quality(docs, labels, fold(F.col("doc_id"), 3) != 1)
    held = docs.join(labels.where(fold(F.col("doc_id"), 3) == 1), "doc_id").select("doc_id", "text", "quality")
    rows = quality.with_quality(held, model).toPandas()
    assert ((rows.score >= 0.5) == (rows.quality == 1)).mean() > 0.97
    x = np.array([quality.text_statistics(t) for t in rows.text])
    z = quality.rule_values(x, model.rules).astype(float) @ np.array(model.weights) + model.intercept
    assert np.allclose(rows.score, 1 / (1 + np.exp(-z)), atol=1e-6)
    out = quality.with_quality(odd, model)
    assert out.columns == odd.columns and out.where("score IS NULL").count() == 0
    assert quality.with_quality(empty, model).count() == 0


# --- chat ------------------------------------------------------------------------


def test_chat_round_trip(spark):
    bits = ["#", "##", "### user: ", "</turn>\n", "</part>", "\\", "<", "/", ":", "a", "\n", "é", "𝄞", ""]
    draw = random.Random(3)
    rows = [
        (c, t, draw.choice(["user", "assistant", "assistant", "a: b", None]), draw.choice([None, "".join(draw.choices(bits, k=6))]))
        for c in range(60)
        for t in range(draw.randint(1, 6))
    ]
    rows += [(None, None, "user", "x"), (None, None, "assistant", "<" * 5000)]
    chats = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.conversation_digest(chats).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == c), key=lambda r: (r[0] is not None, *r[1:]) if r[0] is None else (True, r[0], *r[1:]))
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(none).count() == 0


# --- top-k -----------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["random", "clustered"])
def test_top_k_against_brute_force(spark, shape, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERIES", 20)
    monkeypatch.setattr(topk, "SEEDS", 30)
    draw = np.random.default_rng(5)
    points = draw.normal(size=(600, 6)) if shape == "random" else draw.integers(-3, 4, size=(600, 6)) / 2 + draw.normal(size=(600, 6)) / 50
    rows = [(i, [float(x) for x in p], "c") for i, p in enumerate(points)]
    rows += [(7, rows[7][1], "again"), (None, rows[0][1], ""), (601, None, ""), (602, [1.0, None] * 3, ""), (603, [float("nan")] * 6, "")]
    rows += [(700, [float("inf")] * 6, ""), (800, [1.0, 2.0], ""), (801, [2.0, 2.0], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect()))
    valid = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows if i is not None and i < 600 and v} | {800: [256, 512], 801: [512, 512]}
    want = []
    for q in [i for i in valid if i % 50 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(valid[q], v)), i) for i, v in valid.items() if i != q and len(v) == len(valid[q]))
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_cover_tree_covers():
    points = np.random.default_rng(1).normal(size=(900, 3))
    todo, leaves = [topk.cover_tree(points, np.arange(900), 0)], []
    while todo:
        node = todo.pop()
        assert np.sqrt(((points[node.rows] - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        todo += node.children
        assert not node.children or sum(len(c.rows) for c in node.children) == len(node.rows)
        leaves += [] if node.children else node.rows.tolist()
    assert sorted(leaves) == list(range(900))


# --- simhash ---------------------------------------------------------------------


def brute_fingerprint(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}).encode())
    if not words:
        return 0
    runs = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("block", [4, 1024])
def test_simhash_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    draw = random.Random(11)
    base = [draw.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(draw.randint(0, 99)) for _ in range(300)]
    rows = [(10_000, None), (10_001, ""), (10_002, "  "), (10_003, "One"), (10_004, "one"), (10_005, base[0])]
    for i in range(150):
        words = list(base)
        for _ in range(draw.randint(0, 2)):
            words[draw.randrange(300)] = f"w{draw.randint(0, 5)}"
        rows.append((i, " ".join(words)))
    rows += rows[:2]
    got = simhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {i: brute_fingerprint(t) for i, t in rows}
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" for r in got) and len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == brute_groups(prints)


def test_simhash_matches_spark_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c é"))).first()[0]
    assert simhash.shingle_hashes("A B C é", 4).astype(np.int64).tolist() == [row]


def brute_groups(prints):
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if bin(prints[a] ^ prints[b]).count("1") <= 4 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def test_pairs_under_the_minimum_of_shared_bytes_are_dropped():
    a = np.uint64(0x0102030405060708)
    one_byte_each = np.array([0, 1, 0x0101, 0x010101, 0x01010101, 0x0101010101], dtype=np.uint64)
    assert simhash.shared_bytes(one_byte_each).tolist() == [8, 7, 6, 5, 4, 3]
    assert simhash._near((a ^ one_byte_each) ^ a, 4).tolist() == [True] * 5 + [False]
    assert simhash._near(np.array([0xFF], dtype=np.uint64), 4).tolist() == [False]
    # five shared bytes and more meet in several lists, any pair of four in four of them
    sets = simhash.byte_sets(4)
    assert len(sets) == 56 and sum(set(s) <= {0, 2, 5, 7} for s in sets) == 4


def test_one_of_each_group(spark, odd, empty, tmp_path, monkeypatch):
    draw = random.Random(2)
    base = [f"w{draw.randint(0, 10_000)}" for _ in range(400)]
    rows = []
    for i in draw.sample(range(1000), 80):
        words = list(base) if i % 3 else [f"v{draw.randint(0, 10_000)}" for _ in range(30)]
        for _ in range(draw.randint(0, 6)):
            words[draw.randrange(len(words))] = f"n{draw.randint(0, 99)}"
        rows.append((i, " ".join(words), "", "", ""))
    root = brute_groups({r[0]: brute_fingerprint(r[1]) for r in rows})
    want = sorted(i for i in root if root[i] == i)
    rows += [rows[0], rows[1], (None, rows[2][1], "", "", ""), (None, "alone in its group", "", "", "")]
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, DOCS).withColumns({"__fp": F.lit("own"), "__ROW": F.lit(1)}))
    assert kept.columns == [*odd.columns, "__fp", "__ROW"]
    assert sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i)) == [*want, None]
    assert 1 < len(want) < 60
    # rows of files are told apart by their places, and nothing is written again
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(path)
    for bound in (simhash.BROADCAST_ROWS, 0):
        monkeypatch.setattr(simhash, "BROADCAST_ROWS", bound)
        stored = simhash.one_of_each_group(spark.read.parquet(path))
        assert sorted((r.doc_id for r in stored.collect()), key=lambda i: (i is None, i)) == [*want, None]
    assert "SortMergeJoin" not in stored._jdf.queryExecution().executedPlan().toString()
    wordless = [r for r in simhash.one_of_each_group(odd).collect() if not (r.text or "").split()]
    assert len(wordless) == 1
    assert simhash.one_of_each_group(empty).count() == 0
    assert simhash.fingerprints(empty).count() == 0


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 6000 + i) for i in range(50)]
    got = dict(map(tuple, components(spark.createDataFrame([*edges, (None, 3), (8, 8)], "x long, y long"), "x", "y").collect()))
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


# --- urls ------------------------------------------------------------------------


def test_urls_against_brute_force(spark):
    draw = random.Random(6)
    hosts = ["com", "a.com", "b.a.com", "A.com", "xa.com", "net", "", "a..com", "com.", "c.b.a.com", "ä.com"]
    paths = ["/", "/x", "/x/", "/x/y", "", "/X/"]
    rules = [(draw.choice(hosts), draw.choice(paths), draw.choice(["allow", "block"])) for _ in range(14)] + [(None, "/", "block"), ("com", None, "block")]
    pages = [(i, f"http://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(['', '?q=/x', '#/x'])}", "own") for i in range(400)]
    pages += [(900, None, ""), (901, "no scheme", ""), (None, "http://a.com/x", ""), (None, "http://a.com/x", "")]
    got = urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string, verdict string"), spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(pages)
    by = {}
    for h, p, v in rules:
        if h is not None and p is not None:
            by[h.lower() if h.isascii() else h, p] = max(v, by.get((h.lower() if h.isascii() else h, p), ""))

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fit = [(len(h) + len(p), len(h), h + p, v) for (h, p), v in by.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fit)[2:] if fit else (None, "allow")))

    want = sorted(((i, *judge(u)) for i, u, _ in pages), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str) == want
    no_rules = spark.createDataFrame([], "host string, path string, verdict string")
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(none, no_rules).count() == 0


# --- decontamination -------------------------------------------------------------


@pytest.mark.parametrize("chunk", [30, 100_000])
def test_decontamination_against_brute_force(spark, chunk):
    draw = random.Random(8)
    word = lambda: draw.choice("a b c d E f.g é x1".split())
    items = [(i, " ".join(word() for _ in range(draw.choice([0, 1, 3, 10, 12, 14])))) for i in range(25)] + [(30, None), (3, "x1 x1 zz")]
    docs = [(i, " ".join(word() for _ in range(draw.randint(0, 60))), "own") for i in range(120)]
    docs = [(i, t + " " + items[i % 25][1], f) for i, t, f in docs] + [(None, None, ""), (500, "", ""), (501, "q " * 50_000, "")]
    got = decontaminate.contamination_report(
        spark.createDataFrame(docs, "doc_id long, text string, found string").coalesce(2), spark.createDataFrame(items, "item_id long, text string"), chunk=chunk
    ).collect()
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    want = []
    for i, t, _ in docs:
        w, hit, named = split(t), set(), set()
        for item, said in items:
            s = split(said)
            m = min(10, len(s))
            windows = {tuple(s[k : k + m]) for k in range(len(s) - m + 1)} if m else set()
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    hit |= set(range(k, k + m))
                    named.add(str(item))
        want.append((i, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# --- token counts ----------------------------------------------------------------


def test_rollup_is_idempotent_and_signed(spark, odd):
    versions = token_counts.tokenizers(spark)
    path = scratch_path(spark, "rollup")
    held = token_counts.counted(odd, versions)
    token_counts.commit(held.withColumn("sign", F.lit(1)), 0, path)
    for _ in range(2):
        token_counts.commit(held.where("doc_id = 5").withColumn("sign", F.lit(-1)), 1, path)
    token_counts.commit(held.withColumn("sign", F.lit(1)), 2, path)
    token_counts.commit(held.limit(0).withColumn("sign", F.lit(1)), 2, path)
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in token_counts.totals(spark, path).collect()}
    import tiktoken
    import base64

    with open(token_counts.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("t", pat_str=token_counts.SPLIT, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, text, lang, source, _ in ODD:
        if i == 5:
            continue
        for name, size in (("words-1", len((text or "").split())), ("bpe50k-1", len(bpe.encode_ordinary(text or "")))):
            docs, tokens = want.get((source, lang, name), (0, 0))
            want[source, lang, name] = docs + 1, tokens + size
    assert got == want


# --- html ------------------------------------------------------------------------


def test_main_text_by_template_and_article(spark):
    def page(host, i, body, article=True):
        shell = f"<div><p>Site {host}</p><p>Every page</p></div>"
        main = f"<article><h1>T{i}</h1>{body}</article>" if article else f"<div><h1>T{i}</h1>{body}</div>"
        return (i, f"http://{host}/{i}", f"<html><head><title>x</title></head><body><nav>menu</nav>{shell}{main}<footer>foot</footer></body>", "own")

    pages = [page("a.com", i, f"<p>same everywhere</p><p>own {i} &amp; &eacute;<br>more\n text</p><section class='comments'><p>me too</p></section>") for i in range(8)]
    pages += [page("b.com", 100 + i, f"<p>text {i}</p>", article=False) for i in range(8)]
    pages += [(200, None, None, ""), (201, "http://c.com", "", ""), (202, "http://c.com", "<p>un<b>closed <p>two<li>x</ul></div>", ""), (None, "u", "<script>x</script>", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_main.extract_main_text(df).collect()}
    assert got[3].text == "T3\n\nsame everywhere\n\nown 3 & é more text" and got[3].n_chars == len(got[3].text)
    assert got[103].text == "T103\n\ntext 3"
    assert [got[i].text for i in (200, 201, 202, None)] == ["", "", "unclosed\n\ntwo\n\nx", ""]
    assert html_main.extract_main_text(df.limit(0)).count() == 0


def test_main_text_of_test_pages(spark):
    pages = table(spark, SF, "pages")
    got = {r.page_id: r.text for r in QUERIES["op9_main_text"](spark, SF).collect()}
    for row in pages.collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", row.html).group(1)
        inner = re.sub(r"</?b>", "", re.sub(r"<br>", " ", inner))
        blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[row.page_id] == "\n\n".join(b for b in blocks if b)


# --- the pipeline ----------------------------------------------------------------


def test_folds(spark):
    rows = spark.range(200).select("id", fold(F.col("id"), 4).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 4 for r in rows)


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= docs.count()
        assert kept.exceptAll(docs).count() == 0
        docs = kept
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) == {*docs.columns, "epoch", "taken"}
    assert out.select("doc_id").exceptAll(docs.crossJoin(spark.range(2)).select("doc_id")).count() == 0


def test_pipeline_stages_on_odd_rows(spark, odd, empty):
    import corpus_pipeline

    for frame in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            assert set(frame.columns) <= set(stage(spark, frame, SF).columns)
            stage(spark, frame, SF).count()


def test_clashing_names_in_any_case(spark):
    rows = spark.createDataFrame([(1, "a b c", "s"), (2, "d e", None)], "doc_id long, text string, source string")
    names = {n: F.lit(n) for n in ("__part", "__EPOCHS", "__Size", "Epoch", "TAKEN", "__ROW")}
    mixed = mixing.mixed_texts(rows.withColumns(names))
    assert mixed.columns == ["doc_id", "source", "__part", "__EPOCHS", "__Size", "__ROW", "text", "epoch", "taken"]
    assert {r["__part"] for r in mixed.collect()} == {"__part"}
    model = quality.RuleEnsemble((), (), 0.0)
    scored = quality.with_quality(rows.withColumn("__STATISTICS", F.lit("own")), model)
    assert [r["__STATISTICS"] for r in scored.collect()] == ["own", "own"]


def test_labelled_sample_is_bounded_in_texts(spark):
    docs = spark.createDataFrame([(1, f"t{i}") for i in range(500)] + [(1, None), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", F.lit(True), 10)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "t0", 1.0), (2, None, 0.0)]
