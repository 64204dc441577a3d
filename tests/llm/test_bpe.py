import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kilowatt.llm import bpe
from kilowatt.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    with open(vocabulary(), encoding="utf-8") as f:
        return bpe.ByteBPE(f.read()), tokenizers.Tokenizer.from_file(vocabulary())


def same(both, text):
    ours, theirs = both
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text).tolist() == ids
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    same(both, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeinrst  \n\t'é中0129.!?-=\x1c\x85　́lld<|>", max_size=60))
def test_spaces_and_marks(both, text):
    same(both, text)


def test_special_token_in_a_text(both):
    same(both, "a<|endoftext|>b <|endoftext|><|endoftext|> <|endof")


def test_long_words_stream_with_bounded_memory(both):
    rng = random.Random(4)
    for alphabet in ("a", "=", "ab", "-=", "etaoinshrdlu", "é"):
        same(both, "".join(rng.choice(alphabet) for _ in range(20_000)))


def test_any_cut_of_a_word_gives_the_same_tokens(both):
    model, rng = both[0], random.Random(9)
    word = "".join(rng.choice("abcdeinrst") for _ in range(6000)).encode()
    whole = model.merge(word)
    for step in (1, 13, 500, 2999):
        assert list(model.stream(word[i:i + step] for i in range(0, len(word), step))) == whole


def test_lookahead_of_a_small_list():
    # a chain: (a, b) may undo a; then (x, a…) takes the token before
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 1
    assert bpe.sufficient_lookahead([(b"a", b"b"), (b"x", b"a")]) == 2
    assert bpe.sufficient_lookahead([(b"x", b"a"), (b"a", b"b")]) == 1


def test_decoder_meets_broken_and_unknown_ids(both):
    ours, theirs = both
    ids = theirs.encode("é中🙂", add_special_tokens=False).ids
    for cut in range(len(ids)):
        assert ours.decode(ids[cut:]) == theirs.decode(ids[cut:], skip_special_tokens=False)
        assert ours.decode(ids[:cut]) == theirs.decode(ids[:cut], skip_special_tokens=False)
    assert ours.decode([999_999]) == ""


def test_rows(both, spark, odd_docs, no_docs):
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(odd_docs, vocabulary()).collect()}
    for r in odd_docs.collect():
        assert ids[r["doc_id"]] == both[1].encode(r["text"] or "", add_special_tokens=False).ids
    back = bpe.decode(bpe.encode(odd_docs, vocabulary()), vocabulary())
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == sorted((str(r["doc_id"]), r["text"] or "") for r in odd_docs.collect())
    assert bpe.digests(odd_docs, vocabulary()).count() == odd_docs.count()
    assert bpe.digests(no_docs, vocabulary()).count() == 0


def test_pieces_join_to_the_text(monkeypatch, both):
    monkeypatch.setattr(bpe, "_PIECE", 10)
    text = "some words  and\n\nlines, a'b   c  " * 20
    assert "".join(bpe._pieces(text)) == text
    same(both, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZéÿſ\u0180ªµº²³¹¼½¾×÷\x1c\x1d\x1e\x1f\x85\xa0_'sd 09\t\n\r-=<|>", max_size=80))
def test_latin_and_full_split_agree(both, text):
    same(both, text)
    model = both[0]
    if not bpe._BEYOND.search(text):
        assert bpe._LATIN.findall(text) == model.split.findall(text)


def test_every_latin_character_splits_as_by_the_full_rule(both):
    model = both[0]
    for c in map(chr, range(0x180)):
        for text in (c, f"a{c}b", f" {c} ", f"1{c}1", f"{c}{c}s", f"'{c}"):
            assert bpe._LATIN.findall(text) == model.split.findall(text), hex(ord(c))


def test_ordinary_words_leave_through_the_transducer(both, monkeypatch):
    model, seen = bpe.ByteBPE(open(vocabulary(), encoding="utf-8").read()), []
    feed, end = bpe.Transducer.feed, bpe.Transducer.end

    def fed(self, part):
        seen.append(part)
        return feed(self, part)

    monkeypatch.setattr(bpe.Transducer, "feed", fed)
    monkeypatch.setattr(bpe.Transducer, "end", lambda self: (seen.append(None), end(self))[1])
    model.encode("some ordinary words, words of a text")
    assert [x for x in seen if x is not None] == [b"some", b" ordinary", b" words", b",", b" of", b" a", b" text"] and seen.count(None) == 7


def test_a_transducer_holds_little_and_never_takes_back(both):
    model, rng = both[0], random.Random(3)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(30_000)).encode()
    machine, out, most = bpe.Transducer(model), [], 0
    for i in range(0, len(word), 50):
        out += machine.feed(word[i:i + 50])
        most = max(most, len(machine.held))
        assert out == model.merge(word)[:len(out)] if i % 10_000 == 0 else True
    out += machine.end()
    assert out == model.merge(word) and most <= 4 * model.lookahead + 50


def test_a_long_text_takes_constant_memory(both, spark):
    import hashlib
    import tracemalloc
    model, theirs = both
    text = "Some words and 42 numbers, in a line.\n" * 100_000
    model.encode(text[:1000])
    tracemalloc.start()
    n = sum(len(ids) for ids in model.pieces(text))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert n == len(ids) and peak < 25_000_000  # a piece, not a text's million tokens as objects
    docs = spark.createDataFrame([(1, text), (2, None), (3, "a")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.digests(docs, vocabulary()).collect()}
    assert (got[1]["n_tokens"], got[1]["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert got[1]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert (got[2]["n_tokens"], got[2]["ids_sha256"]) == (0, hashlib.sha256(b"").hexdigest())


def test_digests_equal_the_library_on_a_table(both, spark, sf, odd_docs):
    import hashlib
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        want = []
        for r in docs.collect():
            ids = both[1].encode(r["text"] or "", add_special_tokens=False).ids
            want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(both[1].decode(ids, skip_special_tokens=False))))
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in bpe.digests(docs, vocabulary()).collect())
