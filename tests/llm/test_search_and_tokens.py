"""Lexical search, SentencePiece and alignment against plain Python and the libraries."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest

from granulake.llm import alignment, chunk_codes, lexical_search, queries, sentence_pieces
from granulake.llm.oracles import oracle_sql
from oracle_check import difference

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# --- lexical search ---------------------------------------------------------
def terms(text):
    return TERM.findall((text or "").encode().lower())


def best_by_scan(docs, items, k=20):
    found = [(i, Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in docs) if t]
    documents, length = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        asked = Counter(t for t in terms(text) if df[t])
        w = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) for t in asked}
        scores = []
        for i, c, n in found:
            m = 100 - 25 + (25 * n * documents) // length
            score = sum(r * w[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in asked.items())
            if score > 0:
                scores.append((-score, i is None, i or (0 if i is None else i)))
        out += [(item, r, None if missing else i, -s) for r, (s, missing, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def some_docs(seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "dd", "É", "é", "X1", "9", "zz", "kk", *[f"t{i}" for i in range(30)]]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text(longest):
        return " ".join(rng.choices(words, weights, k=rng.randint(0, longest)))

    docs = [(i if rng.random() > 0.02 else None, text(12)) for i in range(400)]
    docs += [(1000 + i, "t3 t9") for i in range(30)] + [(7, None), (8, ""), (-5, "t3 t9"), (2000, "zz " * 9000)]
    items = [(i, text(8)) for i in range(40)] + [(90, None), (91, "nowhere"), (92, "t3 T9 t9"), (92, "zz"), (None, "b")]
    return docs, items


@pytest.mark.parametrize("sizes", [(3_000_000, 4_000_000, 1_000_000), (50, 100, 200), (1, 1, 1_000_000)])
def test_search_equals_a_scan(spark, monkeypatch, sizes):
    """Ties, repeated rows, null ids and texts, one trie or many, items in one block or several."""
    for name, size in zip(("TREE_ENTRIES", "CELLS", "BLOCK_BYTES"), sizes, strict=True):
        monkeypatch.setattr(lexical_search, name, size)
    docs, items = some_docs(sizes[0])
    left = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, item_id string")
    right = spark.createDataFrame([(i, t, 2) for i, t in [*items, items[3]]], "item_id long, text string, rank int")
    got = lexical_search.ranked(left.repartition(4), right)
    assert sorted(map(tuple, got.collect()), key=str) == best_by_scan(docs, items)


def test_search_of_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "y X"), ("r", "")], "item_id string, text string")
    assert [r[:3] for r in lexical_search.ranked(docs, items).orderBy("rank").collect()][:2] == [("q", 1, "a"), ("q", 2, "b")]
    for left, right in ((docs.limit(0), items), (docs, items.limit(0))):
        empty = lexical_search.ranked(left, right)
        assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.count() == 0


def test_every_bound_holds():
    """No document below a node scores more than the node's bound, and every document is below the root once."""
    import numpy as np

    rng = random.Random(1)
    vectors = []
    for i in range(200):
        ranks = np.array(sorted(rng.sample(range(12), rng.randint(1, 8))))
        vectors.append((ranks, np.array([rng.randint(1, 4) for _ in ranks]), rng.randint(75, 300), i))
    table = np.array([[rng.randint(0, 9) for _ in range(5)] for _ in range(12)])

    def score(ranks, counts, m):
        return (lexical_search.gain(counts, m)[:, None] * table[ranks]).sum(axis=0)

    def below(node):
        ids = [i for _, i in node.own] + [i for child in node.children for i in below(child)]
        bound = score(node.ranks, node.counts, node.m)
        assert all((score(*vectors[i][:3]) <= bound).all() for i in ids) and node.least == min(ids)
        return ids

    assert sorted(below(lexical_search.tree(vectors))) == list(range(200))


# --- SentencePiece ----------------------------------------------------------
MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "", " ", "  ", "▁", "a▁b", " a  b ", "\n\n x\ty", "日本語 テスト", "😀😀 a", "<s> </s> <unk> <0x41>", "\x00a\x00", "é é",
    "ﬃ ＡＢ　x", "a" * 300, "ab" * 500, " " * 50, "​­", "مرحبا", "1234567890", "﻿x", "\r\n", "­soft",
]


def mixed(count, seed=1):
    rng = random.Random(seed)
    parts = [*"ab ▁<>0xé日😀\n\t.,", "the ", "ing", "ﬃ", "　", " <|endoftext|> ", "  "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(count)]


def model_with(rule, squeeze, dummy):
    """The model with another library rule set for normal forms."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    if rule is not None:
        given = sentencepiece_model_pb2.ModelProto()
        given.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        model.normalizer_spec.CopyFrom(given.normalizer_spec)
    model.normalizer_spec.remove_extra_whitespaces, model.normalizer_spec.add_dummy_prefix = squeeze, dummy
    return model.SerializeToString()


@pytest.mark.parametrize(
    "settings",
    [(None, False, True), ("nmt_nfkc", True, True), ("nfkc_cf", True, True), ("nfkc_cf", False, False), ("nmt_nfkc_cf", True, False)],
)
def test_pieces_spans_and_decoding_equal_the_library(settings):
    import sentencepiece

    raw = model_with(*settings)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=raw), sentence_pieces.PieceModel(raw)
    texts = HARD + mixed(400)
    ids, starts, stops, ends = own.encode(texts)
    for text, a, b in zip(texts, ends, ends[1:], strict=False):
        got = ids[a:b].tolist()
        assert got == library.encode(text)
        assert own.decode(got) == library.decode(got)
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(starts[a:b].tolist(), stops[a:b].tolist(), strict=True)) == spans
    rng = random.Random(2)
    for _ in range(1000):
        any_ids = [rng.choice([rng.randrange(40), rng.randrange(3, 259), rng.randrange(32000), 29871]) for _ in range(rng.randint(0, 12))]
        assert own.decode(any_ids) == library.decode(any_ids)


def test_spans_cut_the_text_into_its_pieces(spark):
    texts = [None, *HARD, *mixed(50), "a", "a"]
    docs = spark.createDataFrame([(i, t, "old", 3) for i, t in enumerate(texts)], "doc_id long, text string, decoded string, lang int")
    found = sentence_pieces.encode_decode(docs.repartition(3), MODEL).collect()
    assert len(found) == len(texts) and found[0].__fields__ == ["doc_id", "text", "lang", "ids", "starts", "stops", "decoded"]
    for row in found:
        raw = (texts[row.doc_id] or "").encode()
        assert b"".join(raw[a:b] for a, b in zip(row.starts, row.stops, strict=True)) == raw
        assert row.decoded == (texts[row.doc_id] or "").replace("▁", " ")
    assert sentence_pieces.encode_decode(docs.limit(0), MODEL).count() == 0


def test_chunks_are_coded_again_after_a_fresh_start():
    codes = chunk_codes.ChunkCodes(lambda chunks: [[len(c)] * len(c) for c in chunks], known=2)
    for texts in ([["a", "bb"], ["ccc", "a"]], [["bb"]], [[], ["a"]]):
        ids, ends = codes.tokens(texts)
        assert ids.tolist() == [len(c) for text in texts for c in text for _ in c] and ends[-1] == len(ids)


# --- alignment --------------------------------------------------------------
FILES = [public_tokenizers.path("byte_bpe_50k.json"), MODEL]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def aligned_by_pairs(texts):
    """Every token of one side against every token of the other."""
    import sentencepiece
    from tokenizers import Tokenizer

    left, right = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    left.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}

    def spans(parts):
        ends = [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
        return [(e - len(p), e) for p, e in zip(parts, ends, strict=True)]

    rows, held = [], Counter()
    for text in texts:
        a, b, groups, links = [], [], [], []
        if text:
            a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
            a_bytes = [bytes(byte[c] for c in left.id_to_token(i)) for i in a]
            b_pieces = [right.id_to_piece(i) for i in b]
            b_bytes = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, b_pieces, strict=True)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                at, bt = spans(a_bytes), spans(b_bytes)
                links = [(a[i], b[j]) for i, x in enumerate(at) for j, y in enumerate(bt) if max(x[0], y[0]) < min(x[1], y[1])]
                low = 0
                for end in sorted({e for _, e in at} & {e for _, e in bt}):
                    sides = [[str(i) for i, (_, e) in zip(ids, own, strict=True) if low < e <= end] for ids, own in ((a, at), (b, bt))]
                    groups.append("|".join(map(",".join, sides)))
                    low = end
            else:
                a, b = [], []
        held.update(set(links))
        rows.append((a, b, groups, links))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    return [
        (len(a), len(b), len(g), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), ";".join(g))
        for a, b, g, links in rows
    ]


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_alignment_equals_all_pairs(spark, monkeypatch, block):
    """Null, empty, repeated and odd texts, in one block or many."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    texts = [None, *HARD, *mixed(150, 3), "the same", "the same", None]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, groups string")
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.aligned(docs.repartition(3), *FILES).collect()}
    assert [found[i] for i in range(len(texts))] == aligned_by_pairs(texts)


def test_alignment_of_any_ids_and_no_rows(spark):
    docs = spark.createDataFrame([("x", "a b"), (None, "a b"), ("x", "a b")], "doc_id string, text string")
    found = alignment.aligned(docs, *FILES).collect()
    assert sorted(str(r.doc_id) for r in found) == ["None", "x", "x"] and {r.count_sum for r in found} == {3 * found[0].n_links}
    assert alignment.aligned(docs.limit(0), *FILES).count() == 0


# --- queries ----------------------------------------------------------------
def test_search_query_equals_its_sql(spark):
    name = "op11_lexical_search"
    assert difference(spark, SF_DIR, name, queries.queries()[name], oracle_sql()[name]) is None


def test_token_queries_equal_the_libraries(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in queries.op12_sentence_pieces(spark, SF_DIR).collect():
        ids = library.encode(texts[row.doc_id])
        assert tuple(row)[1:] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    short = {i: t for i, t in texts.items() if len(t) < 1500}
    docs = spark.createDataFrame(list(short.items()), "doc_id long, text string")
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.aligned(docs, *FILES).collect()}
    assert [found[i] for i in short] == aligned_by_pairs(list(short.values()))
    whole = queries.op13_alignment(spark, SF_DIR)
    assert whole.columns == ["doc_id", *COLUMNS[:-1], "groups_sha256"] and whole.count() == len(texts)
