import os
from array import array

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterline.llm import bpe, tokens

PATH = f"{tokens.VOCABULARIES}/{tokens.RANKS}"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    return bpe.Transducer(ranks, bpe.sufficient_lookahead(bpe.merge_pairs(ranks)))


@pytest.fixture(scope="module")
def reference(encoder):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=bpe.WORD_PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}).encode_ordinary


def ids(data):
    return list(array("i", data))


def whole(encoder, text):
    """Ids with every word known in full."""
    return [i for w in regex.findall(bpe.WORD_PATTERN, text) for i in ids(encoder._ids(bpe._merge(w.encode(), encoder.ranks, encoder._none)))]


ALPHABETS = ["ab '", "a1 \n\t.", "เก  ", "'s t'", "   x", "x", " \n　", "é́ö—", "日本語。", "!?. ", "<|endoftext|>"]
TEXT = st.one_of(st.text(max_size=200), *(st.text(alphabet=a, max_size=300) for a in ALPHABETS))


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_ids_agree_with_another_implementation(encoder, reference, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(encoder.encode(text)) == reference(text)


@settings(max_examples=300, deadline=None)
@given(text=TEXT, size=st.sampled_from([1, 2, 3, 5, 17]))
def test_stream_with_a_small_buffer(encoder, reference, text, size):
    text = text.encode("utf-8", "ignore").decode()
    before, bpe.CHUNK = bpe.CHUNK, size
    try:
        streamed = b"".join(encoder.stream(text[i : i + size] for i in range(0, len(text), size)))
    finally:
        bpe.CHUNK = before
    assert ids(streamed) == reference(text)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="'revl ", max_size=60), size=st.sampled_from([1, 2, 3, 5, 17]))
def test_stream_with_contractions(encoder, text, size):
    before, bpe.CHUNK = bpe.CHUNK, size
    try:
        streamed = b"".join(encoder.stream(text[i : i + size] for i in range(0, len(text), size)))
    finally:
        bpe.CHUNK = before
    assert ids(streamed) == whole(encoder, text)


@pytest.mark.parametrize("contraction", ["'re", "'ve", "'ll"])
def test_a_contraction_across_a_chunk(encoder, contraction):
    text = "x " * (bpe.CHUNK // 2 - 3) + "they" + contraction + " late"
    assert text[bpe.CHUNK - 2 : bpe.CHUNK] == contraction[:2]
    assert ids(encoder.encode(text)) == whole(encoder, text)


@settings(max_examples=40, deadline=None)
@given(word=st.text(alphabet="aeinrst", min_size=1500, max_size=6000))
def test_words_beyond_the_lookahead(encoder, reference, word):
    assert ids(encoder.word(word.encode())) == reference(word)


def test_buffer_stays_small(encoder, reference):
    state, out, most = bpe.TextState(encoder), [], 0
    chunk = "abcdefghij" * 500
    for _ in range(60):
        out += state.feed(chunk)
        most = max(most, len(state.rest) + (len(state.open.rest) if state.open else 0))
    out += state.finish()
    assert most <= bpe.CHUNK + 2 * encoder.lookahead + 2 * len(chunk)
    assert ids(b"".join(out)) == reference(chunk * 60)


def test_lookahead_of_small_vocabularies():
    # b c joins before a b, and c d before b c: what follows may change two tokens back.
    ranks = {bytes((c,)): c for c in range(256)} | {b"cd": 256, b"bc": 257, b"ab": 258}
    pairs = bpe.merge_pairs(ranks)
    assert pairs == {b"cd": (b"c", b"d"), b"bc": (b"b", b"c"), b"ab": (b"a", b"b")}
    assert bpe.sufficient_lookahead(pairs) >= 3


@settings(max_examples=60, deadline=None)
@given(merges=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=14), word=st.binary(min_size=1, max_size=400).map(lambda b: bytes(97 + c % 3 for c in b)))
def test_lookahead_suffices_for_any_vocabulary(merges, word):
    ranks = {bytes((c,)): c for c in range(256)}
    made = [b"a", b"b", b"c"]
    for i, j in merges:
        token = made[i % len(made)] + made[j % len(made)]
        if token not in ranks and len(bpe._merge(token, ranks, 10**6)) == 2:
            ranks[token] = 256 + len(ranks)
            made.append(token)
    e = bpe.Transducer(ranks, bpe.sufficient_lookahead(bpe.merge_pairs(ranks)))
    known = ids(e._ids(bpe._merge(word, ranks, 10**6)))
    assert ids(e.word(word)) == known
    state = bpe.WordState(e)
    pieces = [state.feed(word[i : i + 3]) for i in range(0, len(word), 3)]
    assert ids(b"".join(pieces) + state.finish()) == known


@settings(max_examples=200, deadline=None)
@given(text=TEXT)
def test_round_trip(encoder, text):
    text = text.encode("utf-8", "ignore").decode()
    back = {i: t for t, i in encoder.ranks.items()}
    assert "".join(bpe.decode_stream(ids(encoder.encode(text)), back)) == text


@settings(max_examples=300, deadline=None)
@given(data=st.binary(max_size=12))
def test_decoder_on_any_bytes(data):
    tokens_of = {i: bytes((i,)) for i in range(256)}
    assert "".join(bpe.decode_stream(data, tokens_of)) == data.decode("utf-8", "replace")


def test_documents(spark, reference):
    long = "x" * 200_000 + " naïve 日本 " * 20_000
    texts = [(1, "Hello, world!"), (2, None), (3, ""), (4, "  "), (5, long), (6, "Hello, world!"), (None, "no id")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, ids string, n_tokens int")
    found = {r["doc_id"]: r["ids"] for r in tokens.token_ids(df).collect()}
    assert found == {i: reference(t) if t else [] for i, t in texts}
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(df).collect()}
    assert counts == {i: len(v) for i, v in found.items()}
    assert {(r["doc_id"], r["same"]) for r in tokens.round_trip(df.where("doc_id IS NOT NULL")).collect()} == {(i, True) for i in range(1, 7)}
    assert tokens.token_ids(df.limit(0)).count() == 0


def test_memory_is_constant_and_time_in_proportion(encoder):
    import tracemalloc

    words = "The plant's output rose, naïve 日本 4711. " * 1000

    def peak(times):
        tracemalloc.start()
        n = sum(len(x) for x in encoder.stream(words for _ in range(times)))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return n, most

    (few, small), (many, large) = peak(5), peak(100)
    assert many > 19 * few and large < 1.2 * small + (1 << 20)
    random_letters = "".join(chr(97 + (k * k * 31 + k // 7) % 26) for k in range(200_000))
    assert len(encoder.encode(random_letters)) > 0  # quadratic merging would take minutes


def test_one_pass_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = tokens.token_ids(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
