import itertools
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rewardseg.llm import token_files as tf
from rewardseg.llm.tokens import ColumnEncoder, default_tokenizer, encoder, with_end
from rewardseg.session import ensure_checkpoint_dir

TOKENIZER = Tokenizer.from_file(default_tokenizer())


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text(alphabet="ab'1 .\n\té　<|>", max_size=30),
                          st.sampled_from(["a <|endoftext|> b", "it's  two", " lead", "trail ", "a\n b", "a \n b"]))))
def test_column_encoder_equals_the_library(texts):
    ids, per_text = encoder(default_tokenizer()).encode(pa.array(texts, pa.string()))
    assert len(per_text) == len(texts)
    for text, part in zip(texts, np.split(ids, np.cumsum(per_text)[:-1]) if texts else []):
        assert part.tolist() == ids_of(text)


def test_memo_overflow_keeps_results():
    small = ColumnEncoder(default_tokenizer(), memo_words=40)
    for start in range(0, 300, 30):
        texts = [" ".join(f"w{start + i}x the {i}" for i in range(12)) for _ in range(3)]
        ids, per_text = small.encode(pa.array(texts))
        assert ids.tolist() == [x for t in texts for x in ids_of(t)]


def test_end_id_after_every_text():
    ids, counts = with_end(np.array([5, 6, 7], np.uint32), np.array([2, 0, 1]), 0)
    assert ids.tolist() == [5, 6, 0, 0, 7, 0] and counts.tolist() == [3, 1, 2]


def best_limited(counts, limit):
    """The least total of any lengths that satisfy Kraft's inequality."""
    return min(sum(c * l for c, l in zip(counts, lengths))
               for lengths in itertools.product(range(1, limit + 1), repeat=len(counts))
               if sum(2.0 ** -l for l in lengths) <= 1)


def test_package_merge_is_optimal_within_the_limit():
    rng = np.random.default_rng(3)
    for limit in (3, 4):
        for _ in range(12):
            counts = (rng.pareto(0.7, 6) * 10).astype(np.int64) + 1
            lengths = tf.code_lengths(counts, limit)
            assert lengths.max() <= limit and (2.0 ** -lengths).sum() <= 1
            assert (counts * lengths).sum() == best_limited(counts.tolist(), limit)


def test_round_trip_of_blocks():
    rng = np.random.default_rng(5)
    for n, kinds in ((1, 1), (2, 2), (255, 3), (256, 900), (5000, 900)):
        ids = (rng.zipf(1.2, n) % kinds).astype(np.int64)
        lengths = tf.code_lengths(np.bincount(ids, minlength=kinds))
        codes, _ = tf.canonical_codes(lengths)
        payload, checkpoints = tf.pack_bits(ids, codes, lengths)
        assert (tf.Decoder(lengths).decode(payload, checkpoints, n) == ids).all()
        assert len(payload) == (lengths[ids].sum() + 7) // 8


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for doc_id, text, *_ in order:
        ids = [*ids_of(text), 0]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def test_files_of_odd_documents(spark, odd_docs, no_docs, odd_rows):
    path = f"{ensure_checkpoint_dir(spark)}/token-files-odd"
    tf.write_token_files(odd_docs, path)
    got = tf.read_token_files(spark, path, with_ids=True).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(expected(odd_rows), key=key)
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0, *[r.n_tokens for r in by_start][:-1]]).tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in by_start]
    assert ids == sorted(ids)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    empty = f"{ensure_checkpoint_dir(spark)}/token-files-none"
    tf.write_token_files(no_docs, empty)
    assert tf.read_token_files(spark, empty).count() == 0


def test_letters_are_one_piece_of_the_library():
    from tokenizers import pre_tokenizers

    from rewardseg.llm.tokens import byte_letters
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    letters = [chr(c) for c in range(0x80, 0x30000) if chr(c).isalpha()]
    assert len(letters) > 100_000
    for i in range(0, len(letters), 50):
        word = "a" + "".join(letters[i:i + 50])
        assert [p for p, _ in cut(word)] == [byte_letters(word)]
