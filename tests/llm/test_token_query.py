"""The query of token totals against plain Python, on rows that ids do not tell apart."""

import base64
import re

import pyarrow as pa
import pyarrow.parquet as pq
import tiktoken

from shelfmark.llm import token_counts
from shelfmark.llm.queries import LICENSE_LINE, op8_token_counts


def test_query_against_plain_counts(spark, tmp_path):
    said = "Some words here.\nLicensed under X-1\nand more, 42 of them."
    rows = [
        (1, "web", "en", said),
        (1, "web", "en", "another text of the same id\nLicensed under Y\n"),
        (None, "web", "en", "a licensed text without an id\nLicensed under Z"),
        (None, "web", None, None),
        (2, None, "de", said),
        (0, "books", "en", said),
        (0, "books", "en", said),
        (3, "books", "fr", ""),
        (4, "books", "fr", "plain"),
        (None, "books", "fr", "plain"),
        (None, "web", "fr", "plain"),
        (5, "web", "fr", "Licensed under nothing else"),
        *((i, "hot", "en", "copy " * 50) for i in range(100, 400)),
    ]
    names = ["doc_id", "source", "lang", "text"]
    pq.write_table(pa.table({n: list(c) for n, c in zip(names, zip(*rows))}), tmp_path / "documents.parquet")
    with open(token_counts.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("bpe50k", pat_str=token_counts.SPLIT, mergeable_ranks=ranks, special_tokens={})
    count = {
        "words-1": lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)),
        "bpe50k-1": lambda t: len(bpe.encode_ordinary(t)),
    }
    kept = {}
    for doc_id, source, lang, text in rows:
        order = (doc_id is None, doc_id or 0, source is not None, source or "", lang is not None, lang or "")
        if (text or "") not in kept or order < kept[text or ""][0]:
            kept[text or ""] = order, source, lang
    want = {}
    for text, (_, source, lang) in kept.items():
        now = re.sub(LICENSE_LINE, "", text)
        for name, size in count.items():
            docs, tokens = want.get((source, lang, name), (0, 0))
            want[source, lang, name] = docs + 1, tokens + size(now)
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in op8_token_counts(spark, str(tmp_path)).collect()}
    assert got == want
    pq.write_table(pq.read_table(tmp_path / "documents.parquet").slice(0, 0), tmp_path / "documents.parquet")
    assert op8_token_counts(spark, str(tmp_path)).count() == 0
