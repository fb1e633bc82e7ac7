"""Word-level byte-pair encoding against its library, and its own parts."""

import hashlib
import json
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm.queries import QUERIES
from tessera.llm.word_bpe import Memo, WordBpe, decode_words, encode_words, load_word_bpe, word_bpe_round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [
    *" \n\t abcé▁'s\x1c\x85😀ｆ.,1٣字ΣσςİßǅǺ\u0327\u0301\xa0\u3000\u1680\u200b\x00ŉͅᾳﬁẞK", "<|endoftext|>", "<|startoftext|>", "'ll", "'RE",
    "  ", "<s>", "the", "ing", "HELLO", "e\u0301", "\u1112\u1161\u11ab", "한", "\u0558", "\u1c89",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_odd_texts_match_the_library(library):
    bpe, rnd = load_word_bpe(PATH), random.Random(13)
    for _ in range(3000):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60)))
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == want, text
        assert bpe.decode(want) == library.decode(want, skip_special_tokens=False)


def test_every_kind_of_character_matches_the_library(library):
    bpe = load_word_bpe(PATH)
    points = [c for c in range(0x3400) if not 0xD800 <= c < 0xE000] + list(range(0xA640, 0xAC00)) + list(range(0x10000, 0x11000, 3))
    for c in points:
        text = f"a{chr(c)}B {chr(c)}'s"
        assert bpe.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_long_words_without_a_cut(library):
    rnd = random.Random(2)
    for text in ("a" * 5000, "".join(rnd.choice("theinga") for _ in range(5000)), "字" * 3000, "!?" * 2000):
        assert load_word_bpe(PATH).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_a_million_letters_take_seconds():
    rnd = random.Random(3)
    text = "".join(rnd.choice("theingandor") for _ in range(1_000_000))
    assert len(load_word_bpe(PATH).encode(text)) > 100_000


def test_ids_and_digests_of_odd_rows(spark, library, odd_docs, odd_rows):
    got = word_bpe_round_trip(odd_docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, *digests(library, t)) for i, t in odd_rows), key=repr)
    encoded = encode_words(odd_docs, PATH)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in odd_rows]
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=repr) == sorted(want, key=repr)
    decoded = decode_words(encoded, PATH).collect()
    assert sorted(((r.doc_id, r.decoded) for r in decoded), key=repr) == sorted(
        ((i, library.decode(ids, skip_special_tokens=False)) for i, ids in want), key=repr)


def test_no_rows(no_docs):
    assert word_bpe_round_trip(no_docs, PATH).collect() == []


def test_registered_query_matches_the_library(spark, library, sf_dir):
    rows = QUERIES["op13_word_bpe"](spark, sf_dir).collect()
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    assert all(tuple(r)[1:] == digests(library, texts[r.doc_id]) for r in rows)


def test_memo_is_bounded_and_keeps_what_is_used():
    memo, computed = Memo(limit=3, longest=4), []

    def value(text):
        computed.append(text)
        return (text.encode(), b"")

    for texts in (["a", "b"], ["a", "c", "d", "too long"], ["a", "e"], ["a", "too long"], ["a", "f", "g", "h"], ["a"]):
        found = memo.look_up(texts, value)
        assert [found[t] for t in texts] == [(t.encode(), b"") for t in texts]
        assert len(memo.young) <= 7 and "too long" not in memo.young
    assert computed.count("a") == 1 and computed.count("too long") == 2


def test_other_settings_are_refused():
    with open(PATH, encoding="utf-8") as f:
        settings = json.load(f)
    for change in ({"decoder": {"type": "ByteLevel"}}, {"normalizer": None}, {"model": settings["model"] | {"ignore_merges": True}}):
        with pytest.raises(ValueError, match="settings"):
            WordBpe(settings | change)
