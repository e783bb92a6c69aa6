import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from rewardseg.llm import alignment, tokens
from rewardseg.llm.common import table
from tokenizers import Tokenizer

from .conftest import SF

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    return a, b, tokens.byte_table(a)


def spans(text, tools):
    """Whole-text tokens of both kinds as (id, start, end) in bytes."""
    a, b, table_of = tools
    if not text:
        return None
    sides = []
    for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, lambda i: table_of[i]),
                       (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", b.id_to_piece(i))
                        else b.id_to_piece(i).replace("▁", " ").encode())):
        spelled = [spell(i) for i in ids]
        if b"".join(spelled) != b" " + text.encode():
            return None
        ends = np.cumsum([len(s) for s in spelled]).tolist()
        sides.append(list(zip(ids, [0, *ends], ends)))
    return sides


def brute(rows, tools):
    docs = []
    for doc_id, text in rows:
        found = spans(text, tools)
        if found is None:
            docs.append((doc_id, 0, 0, [], ""))
            continue
        a, b = found
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        spelled = ";".join("|".join(",".join(str(i) for i, _, e in side if lo < e <= hi) for side in (a, b)) for lo, hi in zip([0, *common], common))
        docs.append((doc_id, len(a), len(b), links, hashlib.sha256(spelled.encode()).hexdigest(), len(common)))
    counts = Counter(link for d in docs for link in d[3])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return sorted_rows((d[0], d[1], d[2], d[5] if d[3] else 0, len(d[3]), sum(counts[k] == best[k[1]] for k in d[3]), sum(counts[k] for k in d[3]), d[4])
                       for d in docs)


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def short(text):
    return text[:3000] if text else text


def test_products_equal_dense_matrices():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = rng.integers(0, 2, (7, 9)), rng.integers(0, 2, (9, 5))
        csr = lambda m: (np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1])
        indptr, cols, values = alignment.row_products(csr(a), csr(b), 5)
        dense = np.zeros((7, 5), int)
        dense[np.repeat(np.arange(7), np.diff(indptr)), cols] = values
        assert (dense == a @ b).all()
        indptr, rows = alignment.transposed(*csr(b), columns=5)
        assert all((np.flatnonzero(b[:, j]) == rows[indptr[j]:indptr[j + 1]]).all() for j in range(5))


def test_links_of_random_cuts():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        sizes = [np.diff(np.concatenate([[0], np.flatnonzero(rng.random(n - 1) < 0.4) + 1, [n]])) for _ in range(2)]
        (ae, be) = (np.cumsum(s) for s in sizes)
        x, y, shared = alignment.overlap_links(*sizes)
        want = {(i, j): min(ae[i], be[j]) - max(ae[i] - sizes[0][i], be[j] - sizes[1][j]) for i in range(len(ae)) for j in range(len(be))}
        assert dict(zip(zip(x.tolist(), y.tolist()), shared.tolist())) == {k: v for k, v in want.items() if v > 0}
        ga, gb = alignment.group_numbers(*sizes)
        x, y = alignment.group_links(ga, gb)
        assert set(zip(x.tolist(), y.tolist())) == {(i, j) for i in range(len(ga)) for j in range(len(gb)) if ga[i] == gb[j]}


def test_odd_documents_equal_brute_force(odd_docs, odd_rows, no_docs, make_docs, spark, tools):
    odd = ["a  b   c", " leading", "trailing  ", "tab\t and \n  lines \n", "x▁y", "<|endoftext|> <s></s> <0x0A> <unk>", "  nbsp 　 wide", " ", "\n",
           "\x00 null \x1c \x1f sep", "naïve 日本語のテキスト 😀😀", "don't I'll we've 12345678901234567890", "=" * 300, "é ́", "a\r\n b"]
    rows = [(i, short(t), "en", "a") for i, t in ((r[0], r[1]) for r in odd_rows)] + [(300 + i, t, "en", "b") for i, t in enumerate(odd)]
    got = alignment.align(make_docs(rows).repartition(3))
    want = brute([r[:2] for r in rows], tools)
    assert sorted_rows(got.select(*COLUMNS).collect()) == want
    assert alignment.align(no_docs).count() == 0


def test_rare_pairs_meet_their_counts_by_shuffle(spark, tools):
    rows = [(r.doc_id, short(r.text)) for r in table(spark, SF, "documents").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, tools)
    for hot in (0, 50, 1 << 20):
        assert sorted_rows(alignment.align(docs, hot_pairs=hot).select(*COLUMNS).collect()) == want


def test_link_rows(spark, tools):
    rows = [(1, "Unbelievable tokenization, naïvely."), (2, None), (3, "x▁y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = spans(rows[0][1], tools)
    want = {(i, j, x, y, min(e, f) - max(s, t)) for i, (x, s, e) in enumerate(a) for j, (y, t, f) in enumerate(b) if s < f and t < e}
    got = alignment.token_links(docs).collect()
    assert {tuple(r)[1:] for r in got} == want and {r.doc_id for r in got} == {1}
    counts = alignment.align(docs).where("doc_id = 1").first()
    assert alignment.token_links(docs, shared="group").count() == counts.n_group_links


def test_texts_are_aligned_whole_where_words_do_not_fit(tools):
    text = "two words"
    tool = alignment.Aligner(A_PATH, B_PATH)
    by_word = list(tool.align([text]))
    tool.by_word = False
    tool.forget()
    whole = list(tool.align([text, text + "!"]))
    assert whole[0][1] == by_word[0][1] and (whole[0][0] == by_word[0][0]).all()


def test_words_with_line_breaks_are_encoded_together(tools):
    text = " ".join(f"w{i}x.\nY{i}z \tq{i}" for i in range(300)) + " end\n"
    tool, asked = alignment.Aligner(A_PATH, B_PATH), []
    for side in ("_encode_a", "_encode_b"):
        encode = getattr(tool, side)
        setattr(tool, side, lambda words, encode=encode: asked.append(len(words)) or encode(words))
    numbers, digest, pairs = next(tool.align([text]))
    a, b = spans(text, tools)
    assert numbers[:2].tolist() == [len(a), len(b)] and digest == brute([(1, text)], tools)[0][-1]
    assert len(pairs) == numbers[3] == sum(s < f and t < e for _, s, e in a for _, t, f in b)
    assert sum(asked) < 150


def test_pairs_are_looked_up_in_one_pass(make_docs):
    got = alignment.align(make_docs([(1, "some words", "en", "a"), (2, None, "en", "a"), (3, "", "en", "a")]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 0 and got.count() == 3


def test_arrays_of_no_links():
    tool = alignment.Aligner(A_PATH, B_PATH)
    for texts in ([], [None], [None, "", "x▁y", None]):
        numbers, digests, pairs, links = tool.align_column(alignment.pa.array(texts, alignment.pa.string()))
        assert not numbers.any() and not any(digests) and len(pairs) == 0 and links.tolist() == [0] * len(texts) and len(digests) == len(texts)
        column = alignment._binary(pairs, links)
        assert column.type == alignment.pa.binary() and column.to_pylist() == [b""] * len(texts)
        assert [x.tolist() for x in alignment._pairs(column, 4)] == [[], [0] * len(texts)]


def test_other_tokenizers_are_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Two words, two  words", "", "naïve"]
    import pyarrow as pa
    ids, counts = tokens.ColumnEncoder(path).encode(pa.array(texts))
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_query_rows(spark):
    got = alignment.op12_token_alignment(spark, SF)
    assert got.columns[:8] == COLUMNS
    docs = table(spark, SF, "documents")
    assert got.count() == docs.count()
    assert got.where(F.col("n_links") != F.col("n_a") + F.col("n_b") - F.col("n_groups")).count() == 0
