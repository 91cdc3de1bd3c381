"""Aligned tokens against whole texts encoded one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattframe.llm import alignment
from wattframe.llm import queries as Q

SF = "/root/testdata/sf0.001"
A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    byte = alignment.byte_symbols()

    def tokens(text):
        found_a = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        found_b = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
        whole = (" " + text).encode()
        same = all(b"".join(x for _, x in f) == whole for f in (found_a, found_b))
        return (found_a, found_b) if text and same else ([], [])

    def spans(found):
        end, out = 0, []
        for i, x in found:
            out.append((i, end, end + len(x)))
            end += len(x)
        return out

    def run(docs):
        held, counts = [], Counter()
        for doc_id, text in docs:
            a_spans, b_spans = map(spans, tokens(text or ""))
            links = [(i, j) for i, s, e in a_spans for j, u, v in b_spans if s < v and u < e]
            counts.update(links)
            cuts = sorted({e for _, _, e in a_spans} & {e for _, _, e in b_spans})
            groups, low = [], 0
            for cut in cuts:
                groups.append("|".join(",".join(str(i) for i, _, e in x if low < e <= cut) for x in (a_spans, b_spans)))
                low = cut
            held.append((doc_id, len(a_spans), len(b_spans), len(cuts), links, groups))
        best = defaultdict(int)
        for (_, j), n in counts.items():
            best[j] = max(best[j], n)
        return sorted(((d, na, nb, ng, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls),
                        hashlib.sha256(";".join(gs).encode()).hexdigest() if ls else "")
                       for d, na, nb, ng, ls, gs in held), key=str)

    return run


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_equals_the_plain_version(spark, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = [(d, (t or "")[:1500]) for d, t in docs]  # the plain version compares all spans with all
    table = spark.createDataFrame(short, "doc_id long, text string")
    assert found(alignment.aligned(table, A_PATH, B_PATH)) == plain(short)
    whole = {r.doc_id: r for r in Q.QUERIES["op11_alignment"](spark, SF).collect()}
    assert set(whole) == {d for d, _ in docs} and all(whole[d].n_a > 0 for d, t in docs if t)


ODD = ["", None, " ", "  ", "\n", "a", " a", "  two  blanks  ", "end \n", "\ta\tb", "naïve café 漢字 🎉🎉 ëxx",
       "<|endoftext|> <s> </s> <unk> <0x0A> [INST]", "a▁b plain", "▁", " no break 　wide", "\x00 nul \x00",
       "﻿bom x", "don't we'll 's 'S x'", "x́̂ é", "\x1c a\x1d b \x85 c", "\U0010ffff ", "word " * 400,
       "x" * 3000, "12345 67 8.9", "    x", "\r\n a \r\n", "a  b   c    d", "é" * 500 + " " + "漢" * 500]


def test_odd_texts(spark, plain):
    docs = list(enumerate(ODD)) + [(3, "twice"), (3, "twice"), (None, "no id"), (None, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = plain(docs)
    assert found(alignment.aligned(table.repartition(3), A_PATH, B_PATH)) == wanted
    wide = table.withColumns({c: F.lit("x") for c in ("chunk", "pair", "count", "units", "sizes", "n_a", "best")})
    assert found(alignment.aligned(wide, A_PATH, B_PATH)) == wanted
    assert alignment.aligned(table.limit(0), A_PATH, B_PATH).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string")
    assert found(alignment.aligned(nothing, A_PATH, B_PATH)) == plain([(1, None), (2, "▁")])


def test_random_texts_over_many_chunks(spark, plain, monkeypatch):
    chance = random.Random(11)
    letters = "ab cd  \n\t.,'é漢🎉 ▁-9 " + "the of "
    docs = [(i, "".join(chance.choices(letters, k=chance.randint(0, 60)))) for i in range(400)]
    docs = [(i, t if i % 3 else t.replace("▁", "")) for i, t in docs]
    monkeypatch.setattr(alignment, "CHUNK", 300)
    monkeypatch.setattr(alignment, "AT_ONCE", 50)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(alignment.aligned(table, A_PATH, B_PATH)) == plain(docs)
