"""Token files: exact round trips, like the library, damage is noticed."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from passagemill.llm import token_files

PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("case", ["zipf", "same", "all different", "repeating", "short", "empty documents"])
def test_segments(case, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 700)
    rng = np.random.default_rng(2)
    ids = {
        "zipf": np.minimum(rng.zipf(1.3, 9000), 49_000), "same": np.full(5000, 49_407), "all different": rng.permutation(49_000)[:5000],
        "repeating": np.tile(rng.integers(0, 49_000, 40), 120), "short": np.array([1]), "empty documents": np.zeros(0),
    }[case].astype(np.uint32)
    cuts = np.sort(rng.integers(0, len(ids) + 1, 20))
    counts = np.diff(np.concatenate([[0], cuts, [len(ids)]]))
    names = [None, *range(len(counts) - 1)]
    payload = token_files.pack(names, counts, ids)
    back = token_files.unpack(payload)
    assert back[0] == names and (back[1] == counts).all() and (back[2] == ids).all()
    if case == "repeating":
        assert len(payload) < len(ids)  # less than a byte for an id
    if len(ids) > 1:
        with pytest.raises((ValueError, zlib.error)):
            token_files.unpack(payload[:-60] + bytes([payload[-60] ^ 4]) + payload[-59:])


def test_files_like_the_library(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 3000)
    texts = ["Hello, World's  end!\tit's", None, "", "É́ é x  y\x0b'S 's", "don't " * 6000, "áb ́c", "same", "same"]
    rows = [(10 - i if i < 6 else 3, t, 1) for i, t in enumerate(texts)] + [(None, "none", 1)]
    rows += [(100 + i, f"Document number {i} of many words " * (i % 5), 1) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    token_files.write_ids(df, str(tmp_path / "t"), PATH, partitions=4)
    got = sorted(map(tuple, token_files.read_ids(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(PATH)
    want = {}
    for d, t, _ in rows:
        want.setdefault(d, []).append([*library.encode(t or "", add_special_tokens=False).ids, 1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    start = 0
    for d, s, n, ids in got:
        assert s == start and n == len(ids) and ids in want[d]
        want[d].remove(ids)
        start += n
    digests = token_files.read_ids(spark, str(tmp_path / "t"), digest=True).collect()
    assert {(r.start, r.ids_crc32) for r in digests} == {(s, zlib.crc32(np.array(i, "<u4").tobytes())) for _, s, _, i in got}


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    token_files.write_ids(df, str(tmp_path / "t"), PATH)
    assert token_files.read_ids(spark, str(tmp_path / "t")).collect() == []


def test_smaller_than_general_compression(spark, data):
    """The ids of real texts need less than zlib's and less than their order-0 entropy."""
    texts = [r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect()]
    with open(PATH, encoding="utf-8") as file:
        ids = np.frombuffer(b"".join(token_files.WordEncoder(file.read(), 1)(texts)), np.uint32)
    payload = token_files.pack([0], np.array([len(ids)]), ids)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert len(payload) < len(zlib.compress(ids.astype(np.uint16).tobytes(), 6))
    assert len(payload) < -(share * np.log2(share)).sum() / 8 * len(ids)


def tokenizer(pre, normalizer=None, added=()):
    """A tokenizer file of single letters and blanks with the given first steps."""
    import json

    letters = [chr(c) for c in range(33, 127)] + ["Ġ", "Ċ", "▁"]
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "normalizer": normalizer, "pre_tokenizer": pre, "post_processor": None, "decoder": None,
        "added_tokens": [{"id": 500 + i, "content": t, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False} for i, t in enumerate(added)],
        "model": {
            "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False,
            "byte_fallback": False, "ignore_merges": False, "vocab": {c: i for i, c in enumerate(letters)}, "merges": [],
        },
    })


@pytest.mark.parametrize(
    ("file", "cut"),
    [
        (tokenizer({"type": "Whitespace"}), True),
        (tokenizer({"type": "WhitespaceSplit"}, {"type": "Lowercase"}), True),
        (tokenizer({"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}), False),
        (tokenizer({"type": "Metaspace", "replacement": "▁", "prepend_scheme": "always", "split": True}), False),
        (tokenizer({"type": "Split", "pattern": {"Regex": "[a-z]+ ?"}, "behavior": "Removed", "invert": True}), False),
        (tokenizer({"type": "Split", "pattern": {"Regex": "[^\\s]+"}, "behavior": "Removed", "invert": True}), True),
        (tokenizer({"type": "Whitespace"}, added=["a b"]), False),
        (tokenizer({"type": "Whitespace"}, {"type": "Replace", "pattern": {"String": "a b"}, "content": "c"}), False),
        (tokenizer(None), False),
    ],
)
def test_texts_are_cut_only_where_the_tokenizer_drops_blanks(file, cut):
    assert token_files.drops_blanks(file) == cut
    texts = ["a b", "", "some  words\nand lines ", " a b a", "x" * 3000]
    library = Tokenizer.from_str(file)
    got = token_files.WordEncoder(file, 7)(texts)
    assert [np.frombuffer(g, np.uint32).tolist() for g in got] == [[*library.encode(t, add_special_tokens=False).ids, 7] for t in texts]


def test_long_texts_and_forgotten_words(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    monkeypatch.setattr(token_files, "SLICE_CHARS", 400)
    texts = [" ".join(f"w{i * j % 97}x" for j in range(200)) for i in range(12)] + ["one two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    token_files.write_ids(df, str(tmp_path / "t"), PATH, partitions=2)
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r.ids for r in token_files.read_ids(spark, str(tmp_path / "t")).collect()}
    assert got == {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_words_between_ascii_characters_are_cut_off():
    """Words beside commas share one call of the model; what the pattern or the normalizer would join stays whole."""
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.WordEncoder(file.read(), 1)
    texts = [
        "Straße,ÉTÉ! (été) don't 'sun x's !'t o'RE 'L", "e\u0301cole cafe\u0301, H\u0331 =\u0338 a\u0338", "œuvre naïve— a×b÷c ÿ\x9f\u00a0z\x1cq\tw",
        "", "a\r\nb  c", "1a2b ½x _y", "<|endoftext|> <|startoftext|>a", "İstanbul ΣΑΣ К кот", "word" * 700 + ",Word", " ", "\n", "ends", "",
    ]
    library = Tokenizer.from_file(PATH)
    want = [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    for part in (slice(None), *(slice(i, i + 1) for i in range(len(texts)))):
        got = encoder(texts[part])
        assert [np.frombuffer(g, np.uint32).tolist() for g in got] == want[part]
    assert {"straße", "été", "don", "'t "} <= set(encoder.known) and "ÉTÉ!" not in encoder.known
    rng = np.random.default_rng(5)
    signs = list("aZéÉß'st ,.\n\t1—\u0301œ<|×")
    some = ["".join(rng.choice(signs, 40)) for _ in range(500)]
    assert [np.frombuffer(g, np.uint32).tolist()[:-1] for g in encoder(some)] == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def test_a_worker_keeps_its_encoder_and_large_ids_are_coded():
    with open(PATH, encoding="utf-8") as file:
        tokenizer_file = file.read()
    assert token_files._encoder(tokenizer_file, 1) is token_files._encoder(tokenizer_file, 1)
    assert token_files._encoder(tokenizer_file, 2).end != token_files._encoder(tokenizer_file, 1).end
    ids = np.array([1 << 31, 5, 1 << 31, 7] * 900, np.uint32)
    assert (token_files.unpack(token_files.pack([3], np.array([3600]), ids))[2] == ids).all()


@pytest.mark.parametrize("suffix", [None, "s"])
def test_words_of_one_call_are_told_apart(suffix):
    """Ids of many words come from one text; without marks of a word's end, or with missing letters, words are encoded one by one."""
    import json

    settings = json.loads(tokenizer({"type": "Split", "pattern": {"Regex": token_files._PATTERN}, "behavior": "Removed", "invert": True}, {"type": "Lowercase"}))
    settings["model"]["end_of_word_suffix"] = suffix
    vocab = settings["model"]["vocab"]
    if suffix:
        vocab.update({f"{c}s": 200 + i for i, c in enumerate("abcdes")})
    file = json.dumps(settings)
    assert token_files.splits_words(settings)
    library, encoder = Tokenizer.from_str(file), token_files.WordEncoder(file, 7)
    for texts in (["ab Cd, EA abc", "a bb!"], ["ab q d é É ac", "ès fa"], ["", "!"], ["ass sab as sa ba"]):
        assert [np.frombuffer(g, np.uint32).tolist() for g in encoder(texts)] == [[*library.encode(t, add_special_tokens=False).ids, 7] for t in texts]


def test_blocks_of_very_many_different_ids():
    """Order 0 of half a million ids needs chances finer than the shortest interval of the coder may blur."""
    ids = np.random.default_rng(6).permutation(1 << 19).astype(np.uint32)
    payload = token_files.pack([0], np.array([len(ids)]), ids)
    assert (token_files.unpack(payload)[2] == ids).all()
