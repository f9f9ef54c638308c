"""Linked tokens against a plain comparison of byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assayline.llm import token_links
from assayline.llm.queries import QUERIES
from assayline.llm.token_links import default_tokenizers, least_of_most, link_tokens

GIVEN = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = default_tokenizers()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=path_b)


def bytes_a(piece):
    """Byte-level decoding: printable Latin-1 stands for itself, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(x): x for x in own}
    table |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in own)}
    return bytes(table[c] for c in piece)


def bytes_b(model, i):
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


def ranges(pieces):
    made, at = [], 0
    for p in pieces:
        made.append((at, at + len(p)))
        at += len(p)
    return made


def plain(tokenizers, rows):
    """Rows of the contract by comparing every pair of tokens of a text."""
    a, b = tokenizers
    texts = {}
    for _, text in rows:
        if not text or text in texts:
            continue
        ea = a.encode(" " + text, add_special_tokens=False)
        ib = b.encode(text)
        pa = [bytes_a(t) for t in ea.tokens]
        pb = [bytes_b(b, i) for i in ib]
        if b"".join(pa) != (" " + text).encode() or b"".join(pb) != (" " + text).encode():
            continue
        ra, rb = ranges(pa), ranges(pb)
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups = []
        for lo, hi in zip([0, *cuts[:-1]], cuts, strict=True):
            groups.append(
                "|".join(
                    ",".join(str(i) for i, (s, e) in zip(ids, r, strict=True) if lo <= s and e <= hi)
                    for ids, r in ((ea.ids, ra), (ib, rb))
                )
            )
        links = [
            (x, y)
            for x, (s, e) in zip(ea.ids, ra, strict=True)
            for y, (u, v) in zip(ib, rb, strict=True)
            if s < v and u < e
        ]
        texts[text] = (ea.ids, ib, groups, links)
    count = Counter()
    for _, text in rows:
        count.update(set(texts[text][3]) if text in texts else ())
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    made = []
    for doc_id, text in rows:
        if text not in texts:
            made.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, groups, links = texts[text]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        n_best = sum(count[p] == best[p[0]] for p in links)
        made.append((doc_id, len(ids_a), len(ids_b), len(groups), len(links), n_best,
                     sum(count[p] for p in links), digest))
    return sorted(made, key=repr), count, best


def got(measures, id_col="doc_id"):
    rows = measures.select(id_col, *NUMBERS, "groups_sha256").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def corpus():
    pick = random.Random(5)
    words = ["the", "water", "Übung", "naïve", "日本語", "😀", "x1y2", "don't", "ﬁn", "été", "<s>",
             "<|endoftext|>", "<0x41>", "▁", "tokenization", "3.14", " ", "ا", "é", "﻿"]
    rows = [
        (i, pick.choice(["", " "]) + "".join(
            pick.choice(words) + pick.choice([" ", " ", " ", "  ", "\n", "\t", ""])
            for _ in range(pick.randrange(12))))
        for i in range(150)
    ]
    rows += [(1000 + i, "the water of the one text that many rows hold") for i in range(80)]
    return rows


@pytest.mark.parametrize("sent,chunk", [(100_000, 1 << 20), (20, 200), (0, 1)])
def test_links_equal_a_plain_comparison(spark, tokenizers, monkeypatch, sent, chunk):
    monkeypatch.setattr(token_links, "SENT", sent)
    rows = corpus()
    measures, pairs = link_tokens(spark.createDataFrame(rows, DOCS).repartition(4))
    want, count, best = plain(tokenizers, rows)
    assert got(measures) == want
    assert sum(r[1] == 0 for r in want) > 3 and sum(r[1] > 0 for r in want) > 150
    assert {(r.a, r.b): (r.n, r.best) for r in pairs.collect()} == {
        p: (n, n == best[p[0]]) for p, n in count.items()
    }


def test_chunks_do_not_change_the_alignment():
    aligner = token_links.Aligner(*default_tokenizers())
    texts = [t for _, t in corpus() if t]
    whole = aligner.align(texts)
    for k, text in enumerate(texts[:40]):
        alone = aligner.align([text])
        for name, values in whole.items():
            assert (values[k].as_py() if name == "pairs" else values[k]) == (
                alone[name][0].as_py() if name == "pairs" else alone[name][0]
            )
    assert aligner.align([])["n_a"] == []


def test_edge_rows_of_tokens(spark, tokenizers):
    rows = [
        (1, None), (2, ""), (3, " "), (4, "\n\n"), (5, "a"), (5, "a"), (None, "a"), (None, None),
        (6, "word and more words " * 20_000), (7, "x" * 30_000), (8, "▁ ▁"), (9, "\x00"),
    ]
    names = ("id", "key", "times", "n_a", "pairs", "a", "b", "n", "groups", "best")
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in names})
    measures, _ = link_tokens(df.repartition(3))
    made = {(r[0], r[1]): r for r in got(measures)}
    short = [r for r in rows if len(r[1] or "") < 1000]
    want, _, _ = plain(tokenizers, short)
    assert measures.count() == len(rows)
    for row in want:
        assert made[(row[0], row[1])][1:5] + made[(row[0], row[1])][7:] == row[1:5] + row[7:]
    long = next(r for r in got(measures) if r[0] == 6)
    assert long[1] == 80_001 and long[3] <= long[2] <= long[4]


def test_empty_table_of_tokens(spark):
    measures, pairs = link_tokens(spark.createDataFrame([], DOCS))
    assert measures.count() == 0 and pairs.count() == 0
    assert measures.columns == ["doc_id", *NUMBERS, "groups_sha256"]


def test_least_of_most(spark):
    df = spark.createDataFrame([(1 << k % 6,) for k in range(60)], "n long")
    for most in (0, 9, 10, 25, 60):
        assert df.filter(F.col("n") >= least_of_most(df, most)).count() <= most
    assert least_of_most(df, 60) == 1


def test_query_on_the_given_documents(spark, tokenizers):
    if not Path(GIVEN).exists():
        pytest.skip("test tables are not here")
    table = spark.read.parquet(f"{GIVEN}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in table]
    made = got(QUERIES["op12_token_links"](spark, GIVEN))
    a, _ = tokenizers
    ids = {r[0]: r for r in made}
    assert len(made) == len(rows)
    for doc_id, text in rows[:40]:
        if ids[doc_id][1]:
            assert ids[doc_id][1] == len(a.encode(" " + text, add_special_tokens=False).ids)
    short = sorted(rows, key=lambda r: len(r[1] or ""))[:60]
    mine, _ = link_tokens(spark.createDataFrame(short, DOCS))
    assert got(mine) == plain(tokenizers, short)[0]
