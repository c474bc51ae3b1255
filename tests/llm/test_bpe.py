"""BPE automaton against the tokenizers library, exactly."""

import hashlib
import pickle
import random
import tracemalloc

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import SF, clashing, docs, rows
from weir.llm import bpe


@pytest.fixture(scope="module")
def both():
    spec = bpe.read_spec(bpe.default_path())
    lib = Tokenizer.from_str(spec)
    lib.no_truncation()
    lib.no_padding()
    return bpe.automaton(spec), lib


def same(auto, lib, text):
    ids = lib.encode(text, add_special_tokens=False).ids
    got = auto.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids, repr(text[:200])
    assert auto.decode(got).decode() == lib.decode(ids, skip_special_tokens=False)


def test_random_texts(both):
    rng = random.Random(2)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCXYZ0123456789'’ \n\t.!?-éüßÀİΣσς日本́ﬁ\x1c\x85\xa0​ǅ½²٣"
    vocab = [w.replace("</w>", "") for w in lib_words(both[1])]
    for _ in range(4000):
        same(*both, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))))
        same(*both, "".join(rng.choice("aab'") for _ in range(rng.randint(0, 30))))
        same(*both, "".join(rng.choice(vocab) for _ in range(4)))


def test_transition_table(both):
    """Every stored transition leads to a state in which the token it completes is the one
    that may be followed by any arc; a known word is read from the table alone."""
    auto, lib = both
    auto._restart()
    for word in ("antidisestablishment", "hello", "helloworld", "aaaaaaaaaaaa"):
        path = auto.encode_word(word.encode())
        assert path == lib.encode(word, add_special_tokens=False).ids
        states = len(auto.sets)
        assert auto.encode_word(word.encode()) == path and len(auto.sets) == states   # read from the table alone
        state = 0
        for byte in word.encode()[:-1]:
            state, token = auto.table[state << 8 | byte]
            assert [p for p, node in auto.sets[state] if node == 0] == [token]
    assert len(auto.sets) == len(auto.numbers)


def test_a_full_table_starts_again(both, monkeypatch):
    auto, lib = both
    monkeypatch.setattr(bpe, "STATES", 50)
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 40)))
        assert auto.encode_word(text.encode()) == lib.encode(text, add_special_tokens=False).ids
        assert len(auto.sets) <= 50 + len(text)


def test_tables_stay_bounded_and_right(both, monkeypatch):
    """Words that leave a full table walk on beside it; after enough of them it starts again."""
    auto, lib = pickle.loads(pickle.dumps(both[0])), both[1]
    for name, value in (("STATES", 60), ("CACHE", 40), ("MISSED", 5)):
        monkeypatch.setattr(bpe, name, value)
    rng, starts = random.Random(5), 0
    for _ in range(1500):
        missed = auto.missed
        same(auto, lib, " ".join("".join(rng.choice("abcdefghié日") for _ in range(rng.randint(1, 12))) for _ in range(3)))
        starts += auto.missed < missed
        assert len(auto.sets) == len(auto.numbers) <= 60 and len(auto.table) <= 240 and len(auto.ends) <= 120
        assert len(auto.cache) <= 20 and len(auto.old) <= 20
    assert starts > 1


def test_a_worker_holds_little(both):
    """Tables and everything remembered, with more rare words than fit: one worker's share of an
    executor, which has several (127 MB before, and not yet full)."""
    auto = pickle.dumps(both[0])
    assert len(auto) < 5_000_000
    rng = random.Random(6)
    tracemalloc.start()
    try:
        auto = pickle.loads(auto)
        for _ in range(120_000):
            auto.encode("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 9))))
        assert len(auto.sets) == bpe.STATES and len(auto.cache) + len(auto.old) > bpe.CACHE // 2
        assert tracemalloc.get_traced_memory()[1] < 70e6
    finally:
        tracemalloc.stop()


def lib_words(lib):
    return sorted(lib.get_vocab())


def test_special_tokens_runs_and_long_words(both):
    for text in ["a<|endoftext|>b <|startoftext|>", "<|endoftext|><|endoftext|>", "", "don't they'll I'm 've",
                 "a" * 5000, "the" * 7000, "ab" * 4000, "é" * 3000, "日" * 500, "x\x00y", " \n\t"]:
        same(*both, text)


def test_states_one_per_merge_at_most(both):
    auto, _ = both
    assert auto.states <= 1 + 48894


def test_accepts_exactly_the_library_tokenizations(both):
    """A token pair has an arc if and only if the library keeps it apart."""
    auto, lib = both
    rng = random.Random(9)
    inner = sorted(auto.inner.items())
    final = sorted(auto.final.items())
    for _ in range(5000):
        (a, i), (b, j) = rng.choice(inner), rng.choice(final)
        try:
            word = (a + b).decode()
        except UnicodeDecodeError:
            continue
        if not word.isalpha() or word != word.lower():
            continue
        ids = lib.encode(word, add_special_tokens=False).ids
        assert (ids == [i, j]) == auto.follows(i, j)


def digest(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_query_rows(spark, both):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(((r.doc_id, *digest(both[1], r.text)) for r in df.collect()), key=repr)
    assert rows(bpe.token_digest(df)) == want


def test_awkward_rows(spark, both):
    df = docs(spark, [None, "", "Hello there", "Hello there", "x" * 100000], ids=[1, 2, 3, 3, None])
    want = sorted(((r.doc_id, *digest(both[1], r.text)) for r in df.collect()), key=repr)
    assert rows(bpe.token_digest(clashing(df))) == want
    out = bpe.with_tokens(clashing(df))
    assert out.where("text = 'Hello there'").select("decoded").distinct().collect()[0][0] == "hello</w> there</w>"
    assert bpe.token_digest(docs(spark, [])).count() == 0
