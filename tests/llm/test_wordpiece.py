import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from pressroom.llm.common import WORD
from pressroom.llm.wordpiece import Automaton, from_ranks, with_piece_counts

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def greedy(first, later, word):
    pieces, at, some = [], 0, first
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in some), None)
        if end is None:
            return 1
        pieces.append(word[at:end])
        at, some = end, later
    return len(pieces)


@settings(deadline=None, max_examples=300)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.sets(st.text("abc", min_size=1, max_size=5), max_size=12),
       st.lists(st.text("abcd", max_size=14), max_size=20))
def test_counts_are_those_of_greedy_matching(first, later, words):
    first, later = {x.encode() for x in first}, {x.encode() for x in later}
    automaton = Automaton(first, later)
    for word in words:
        assert automaton.count(word.encode()) == greedy(first, later, word.encode())


def test_whole_texts(odd):
    import re

    automaton = from_ranks(PATH)
    rng = random.Random(1)
    rows = with_piece_counts(odd, PATH).collect()
    assert len(rows) == odd.count()
    for r in rows:
        words = re.findall(WORD, r["text"] or "")
        assert r["n_words"] == len(words) and r["n_pieces"] == sum(automaton.count(w.encode()) for w in words)
        assert r["node"] == "x"
    tokens = [t for t in automaton_tokens() if len(t) > 1]
    first, later = {t[1:] for t in tokens if t[:1] == b" "}, {t for t in tokens if t[:1] != b" "}
    first |= {bytes([b]) for b in range(256) if b != 32}
    later |= {bytes([b]) for b in range(256) if b != 32}
    for _ in range(300):
        word = bytes(rng.choice(b"thequickbrown") for _ in range(rng.randint(1, 12)))
        assert automaton.count(word) == greedy(first, later, word)


def automaton_tokens():
    from pressroom.llm.bpe import Ranks

    return Ranks(PATH).rank


def test_no_rows(none):
    assert with_piece_counts(none, PATH).count() == 0
