"""Encoding, token files, packing and token counts against the plain libraries."""

import random
import tracemalloc
import zlib
from collections import defaultdict
from functools import cache
from math import ceil

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tests.llm.edges import ROWS, awkward, empty
from trustlake.llm import token_files
from trustlake.llm.encoding import _SETTLED, Encoder, Remembered, encoder
from trustlake.llm.packing import best_fit, pack
from trustlake.llm.token_counts import LONG, MARK, count_tokens, load_pieces, long_count, trie_counts, with_beginnings
from trustlake.llm.token_files import address, read_digests, read_token_ids, write_token_files
from trustlake.llm.words import WordHashes
from trustlake.session import work_dir

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@cache
def plain_tokenizer(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@cache
def direct(path, text):
    return plain_tokenizer(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_remembered_pieces_change_nothing(path):
    rng = random.Random(3)
    letters = "abAB '\n\t.,!12éßÉİ —“² \u0085\x1csStT日本́|$_<>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a  b", "a   b", "a \n b", "x\n\n  y ", " a", "  a ", "a\tb c", "\0 a", "a\0b c", "", " ", "a b\nc d"]
    texts += ["<|endoftext|> a <|startoftext|>", "it's WE'LL 'S", "  two  spaces \n\n new ", "١٢٣ ǅ", "x" * 5000]
    own, plain = Encoder(path), plain_tokenizer(path)
    assert own.cut is not None
    own.piece_ids.size = 50  # generations change often
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_settled_character(path):
    own, plain = Encoder(path), plain_tokenizer(path)
    for char in map(chr, _SETTLED):
        for text in (char, f"AB{char}CD ab{char}cd", f"x {char}{char.lower()} y", f"1{char}2 .{char}."):
            assert np.frombuffer(own.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


MARKED = ["x <|endoftext|> y", "<|endoftext|>", "<|startoftext|>a  <|endoftext|>\n b<|endoftext|>", "<|ENDOFTEXT|> <|endoftext |>",
          "Ə <|endoftext|>日", "no marker  here", ""]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_markers_as_the_untouched_library_reads_them(spark, path):
    library = Tokenizer.from_file(path)
    expected = [library.encode(text, add_special_tokens=False).ids for text in MARKED]
    assert [np.frombuffer(encoder(path).ids(text), "<u4").tolist() for text in MARKED] == expected
    docs, folder = awkward(spark, list(enumerate(MARKED))), work_dir(spark, "tokens")
    read = sorted(read_token_ids(write_token_files(docs, folder, path), folder).collect(), key=lambda r: r.doc_id)
    assert [r.ids for r in read] == [[*ids, 0] for ids in expected]
    assert [r.start for r in read] == np.cumsum([0, *(len(ids) + 1 for ids in expected)])[:-1].tolist()
    if path == WORDS:
        packed = sorted((r.doc_id, r.length, r.ids_crc32) for r in pack(docs, path).collect())
        assert packed == [(i, len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())) for i, ids in enumerate(expected)]


def by_id(rows):
    """Rows in the files' order: null ids first."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_token_files_round_trip(spark, path):
    folder = work_dir(spark, "tokens")
    manifest = write_token_files(awkward(spark).repartition(3), folder, path)
    read = read_token_ids(manifest, folder).collect()
    expected = [(i, [*direct(path, t), 0]) for i, t in ROWS]
    assert sorted(((r.doc_id, r.ids) for r in read), key=repr) == sorted(expected, key=repr)
    in_order = sorted(read, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [i for i, _ in by_id(ROWS)]
    assert [r.start for r in in_order] == np.cumsum([0, *(r.n_tokens for r in in_order)])[:-1].tolist()
    digests = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in read_digests(manifest, folder).collect()}
    assert digests == {
        (r.doc_id, r.start): (len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in read
    }


def test_files_of_no_documents(spark):
    folder = work_dir(spark, "tokens")
    assert read_token_ids(write_token_files(empty(spark), folder, BYTES), folder).count() == 0


def test_token_files_are_flat(spark, small):
    folder = work_dir(spark, "tokens")
    manifest = write_token_files(spark.read.parquet(f"{small}/documents.parquet"), folder, BYTES).orderBy("part").collect()
    path = folder.removeprefix("file://")
    for part in manifest:
        offsets = np.memmap(f"{path}/{part.name}.idx", "<i8", "r")
        ids = np.memmap(f"{path}/{part.name}.bin", f"<u{part.width}", "r")
        assert part.width == 2 and offsets[0] == 0 and offsets[-1] == len(ids) == part.ids and len(offsets) == part.docs + 1
        assert (ids[offsets[1:] - 1] == 0).all()


def check_packing(rows, packed, length):
    """All pieces of all documents, in place and without gaps."""
    whole = defaultdict(list)
    for r in packed:
        whole[r.sequence_id].append(r)
    for members in whole.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    expected = []
    for ident, text in rows:
        ids = np.array([*direct(WORDS, text), 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), length)):
            part = ids[start : start + length]
            expected.append((ident, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r[:5]) for r in packed), key=repr) == sorted(expected, key=repr)
    return len(whole), sum(r[3] for r in expected)


def test_packing_of_awkward_rows(spark):
    check_packing(ROWS, pack(awkward(spark), WORDS).collect(), 2048)
    assert pack(empty(spark), WORDS).count() == 0


@pytest.mark.parametrize("task_rows", [200_000, 60, 7])
def test_packing_in_rounds(spark, small, task_rows):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    bins, tokens = check_packing(rows, pack(docs, WORDS, task_rows=task_rows).collect(), 2048)
    assert bins <= 1.15 * ceil(tokens / 2048)


def test_documents_that_do_not_fit_together_end_the_rounds(spark):
    rows = [(i, "a " * 1100) for i in range(60)]
    assert check_packing(rows, pack(awkward(spark, rows), WORDS, task_rows=10).collect(), 2048)[0] == 60


def test_best_fit_takes_the_tightest_bin():
    sizes = np.array([6, 7, 4, 3, 1])
    bins, places, filled = best_fit(sizes, 10)
    # 7 and 6 open bins; 4 fits 6's exactly, 3 fits 7's exactly, 1 needs a new one
    assert bins[1] == bins[3] and bins[0] == bins[2] and filled.tolist() == [10, 10, 1]
    assert places[3] == 7 and places[2] == 6
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 101, 5000)
    bins, places, filled = best_fit(sizes, 100)
    assert filled.max() <= 100 and np.bincount(bins, sizes).tolist() == filled.tolist()
    assert len(filled) <= 1.05 * sizes.sum() / 100


def brute_count(word, pieces):
    """The best segmentation by trying all of them."""
    text, scores = MARK + word, {p: s for p, s in pieces.scores.items() if s is not None}

    def best(start):
        if start == len(text):
            return (0.0, 0)
        size = len(text[start].encode())
        rest = best(start + 1)
        found = (rest[0] + size * pieces.byte_score, rest[1] - size)
        for end in range(start + 1, len(text) + 1):
            if text[start:end] in scores:
                rest = best(end)
                found = max(found, (rest[0] + scores[text[start:end]], rest[1] - 1))
        return found

    return -best(0)[1]


def test_counts_per_shared_prefix():
    pieces = with_beginnings({MARK: -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "aba": -3.5, "bab": -4.0, MARK + "a": -2.2}, -9.0)
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc日") for _ in range(rng.randint(0, 9))) for _ in range(400)})
    assert dict(trie_counts(words, pieces)) == {w: brute_count(w, pieces) for w in words}


def test_counts_of_documents(spark, small):
    pieces = load_pieces(PIECES)
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(20)
    rows = [*ROWS[:9], *ROWS[11:], *((r.doc_id, r.text[:400]) for r in docs.collect())]
    found = count_tokens(awkward(spark, rows), PIECES).collect()
    expected = [
        (i, len((t or "").split()), sum(next(n for _, n in trie_counts([w], pieces)) for w in (t or "").split())) for i, t in rows
    ]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(expected, key=repr)
    assert count_tokens(empty(spark), PIECES).count() == 0


def test_long_words_are_streamed():
    """The same counts with the scores of a few characters at a time, and little memory."""
    dice = random.Random(2)
    pieces = load_pieces(PIECES)
    toy = with_beginnings({MARK: -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "aba": -3.5, "bab": -4.0, MARK + "a": -2.2}, -9.0)
    for count in (1, 2, 5, 60, 500, 3000):
        word = "".join(dice.choices("abcétion日", k=count))
        for known in (pieces, toy):
            assert long_count(word, known) == dict(trie_counts([word], known))[word]
    word = "".join(dice.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=300_000))
    tracemalloc.start()
    assert long_count(word, pieces) > 100_000
    assert tracemalloc.get_traced_memory()[1] < 1 << 20
    tracemalloc.stop()


def test_words_of_any_length_in_a_table(spark):
    pieces = load_pieces(PIECES)
    words = ["a" * n for n in (1, LONG - 1, LONG, LONG + 1, 5 * LONG)]
    rows = [(i, " ".join(words[: i + 1])) for i in range(len(words))]
    found = count_tokens(awkward(spark, rows), PIECES).collect()
    one = {w: dict(trie_counts([w], pieces))[w] for w in words}
    assert {r.doc_id: r.n_tokens for r in found} == {i: sum(one[w] for w in words[: i + 1]) for i in range(len(words))}


def test_caches_hold_no_long_texts(spark):
    hashes, remembered = WordHashes(), Remembered(str.encode, 10)
    assert hashes[b"x" * 100] == xxhash.xxh64_intdigest(b"x" * 100) and hashes[b"x"] and list(hashes) == [b"x"]
    assert remembered["x" * 100] == b"x" * 100 and not remembered


def test_a_folder_without_a_scheme_is_spark_s(spark):
    assert address(spark, "/x/y") == "file:///x/y" and address(spark, "s3://b/x") == "s3://b/x"
    spark.conf.set("spark.hadoop.fs.defaultFS", "hdfs://name:9000/")
    try:
        assert address(spark, "/x/y") == "hdfs://name:9000/x/y"
    finally:
        spark.conf.unset("spark.hadoop.fs.defaultFS")


def test_a_folder_without_a_scheme_on_a_cluster_lies_where_spark_says(spark, folder):
    folder, master = f"{folder}/a é%#b", spark.conf.get("spark.master")
    expected = [[*direct(BYTES, text), 0] for text in ("", "one two", "日 x")]
    docs = awkward(spark, list(enumerate(["", "one two", "日 x"])))
    spark.conf.set("spark.master", "spark://somewhere:7077")
    try:
        manifest = write_token_files(docs, folder, BYTES)
        assert [r.ids for r in read_token_ids(manifest, folder).orderBy("doc_id").collect()] == expected
        assert read_digests(write_token_files(empty(spark), f"{folder}/none", BYTES), f"{folder}/none").count() == 0
    finally:
        spark.conf.set("spark.master", master)


def test_parts_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 1 << 14)
    rows = [(i, f"text {i} " * 100) for i in range(120)]
    folder = work_dir(spark, "tokens")
    manifest = write_token_files(awkward(spark, rows), folder, BYTES)
    parts = [r.docs for r in manifest.collect()]
    assert len(parts) > 4 and sum(parts) == 120 and max(parts) <= 40
    read = read_token_ids(manifest, folder).orderBy("start").collect()
    assert [(r.doc_id, r.ids) for r in read] == [(i, [*direct(BYTES, text), 0]) for i, text in rows]
