import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from moodlake.llm import packing, token_counts
from moodlake.llm.common import read_table
from moodlake.llm.queries import op2_token_histogram, op4_pack
from moodlake.llm.tokens import WordEncoder

from tests.conftest import SF_SMALL

TOK = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [2]


def test_encoder_equals_tokenizer():
    odd = ["Straße ΑΣ Σ ΣΑΣ", "é áb", "ﬁ Ⅷ ½ ² x²", "<|endoftext|>a <|startoftext|>", "a b c\x1cd\x85e",
           "日本語 テスト", "İstanbul ǅ", "don't 'S 'LL we'Ve", "", "  ", "\x00a", "ªº µ Å Å", "1234 5a6", " \x0b\x0c x",
           "a‍b", "<| endoftext|>", "é café", "x" * 5000, "!!??.,;", "A.B,C", "end.", "\x7f\x80 \xad"]
    enc = WordEncoder("word_bpe_49k.json")
    assert enc.plain
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(odd)] == [ids_of(t)[:-1] for t in odd]


def test_other_tokenizers_are_called_on_whole_texts():
    enc = WordEncoder("byte_bpe_50k.json")
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not enc.plain
    text = "Two  words,\n one é."
    assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def check_packing(rows, want, window=4096):
    """Every id in exactly one piece; sequences without gaps; returns the share of padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == want.keys()
    for doc, ids in want.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert r.start == at and zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)
    pad = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= window
        total += at
        pad += 0 if at & (at - 1) == 0 else window - at
    return pad / total


def test_pack_round_trip(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    want = {d.doc_id: ids_of(d.text) for d in docs.select("doc_id", "text").collect()}
    assert check_packing(op4_pack(spark, SF_SMALL).collect(), want) < 0.05


def test_pack_many_partitions_with_few_windows(spark):
    docs = spark.createDataFrame([(i, "w " * (i * 37 % 150)) for i in range(300)], "doc_id long, text string").repartition(13)
    want = {d.doc_id: ids_of(d.text) for d in docs.collect()}
    out = packing.digest(packing.pack_documents(docs, window=128, open_windows=3, merge_group=4)).collect()
    assert check_packing(out, want, 128) < 0.15


def test_pack_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    total = sum(len(ids_of(r.text)) for r in odd_docs.select("text").collect())
    assert sum(r.length for r in rows) == total == sum(len(r.ids) // 4 for r in rows)
    assert [r.length for r in rows if r.doc_id == 4] == [1] and len([r for r in rows if r.doc_id == 2]) == 2
    assert packing.pack_documents(no_docs).collect() == []


def test_histogram_against_brute_force(spark):
    lens = sorted(len(ids_of(r.text)) for r in read_table(spark, SF_SMALL, "documents").select("text").collect())
    rows = op2_token_histogram(spark, SF_SMALL).collect()
    assert [r.length for r in sorted(rows, key=lambda r: r.length)] == sorted(set(lens))
    for r in rows:
        assert r.n_docs == lens.count(r.length) and r.docs_total == len(lens) and r.tokens_total == sum(lens)
        assert r.docs_upto == sum(n <= r.length for n in lens) and r.docs_atleast == sum(n >= r.length for n in lens)
        assert r.tokens_atleast == sum(n for n in lens if n >= r.length)
        assert r.tokens_cut == sum(min(n, r.length) for n in lens)


def test_limits_and_quantiles(spark):
    lens = [1, 1, 5, 9, 700, 700, 3000]
    hist = token_counts.length_histogram(spark.createDataFrame([(n,) for n in lens], "length long")).cache()
    got = {r.context_limit: (r.docs_fit, r.docs_cut, r.tokens_kept) for r in token_counts.at_limits(hist, [1, 8, 700, 9999]).collect()}
    assert got == {k: (sum(n <= k for n in lens), sum(n > k for n in lens), sum(min(n, k) for n in lens)) for k in got}
    assert {r.prob: r.length for r in token_counts.quantiles(hist, [0.25, 0.5, 1.0]).collect()} == {0.25: 1, 0.5: 9, 1.0: 3000}


def test_lengths_of_odd_rows(odd_docs, no_docs):
    got = sorted(r.length for r in token_counts.lengths(odd_docs).collect())
    assert got == sorted(len(ids_of(r.text)) for r in odd_docs.select("text").collect())
    empty = token_counts.length_histogram(token_counts.lengths(no_docs))
    assert empty.agg(F.count("*")).first()[0] == 0
    assert token_counts.at_limits(empty, [8]).collect()[0][1:] == (0, 0, 0)
