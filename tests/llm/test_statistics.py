"""The statistics behind the quality rules, against counts taken word by word and character by character."""

import re
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm.quality import STATISTICS, text_statistics


def plain(text):
    words = text.split()
    joined = "".join(words)
    n, chars = len(words), len(joined)
    letters = [c for c in joined if c.isalpha()]
    lines = [line for line in text.split("\n") if line.split()]
    neighbours = list(zip(words, words[1:]))
    commonest = max(len(list(same)) for _, same in groupby(sorted(words)))
    return {
        "words": n,
        "chars_per_word": chars / n,
        "longest_word": max(len(w) for w in words),
        "symbol_share": len(re.sub(r"[\w\s.,;:!?'\"()-]", "", joined)) / chars,
        "digit_share": len([c for c in joined if c.isdigit()]) / chars,
        "upper_share": len([c for c in letters if c.isupper()]) / max(len(letters), 1),
        "letter_share": len(letters) / chars,
        "bare_symbol_words": len([w for w in words if not any(map(str.isalpha, w))]) / n,
        "exclaimed_words": len([w for w in words if w.endswith(("!", "?"))]) / n,
        "sentence_words": len([w for w in words if w.endswith((".", "!", "?"))]) / n,
        "distinct_words": len(set(words)) / n,
        "same_as_before": len([1 for a, b in neighbours if a == b]) / n,
        "top_word_share": commonest / n,
        "lines_per_word": min(len(lines) / n, 1),
        "distinct_lines": len(set(lines)) / max(len(lines), 1),
        "distinct_pairs": len(set(neighbours)) / max(n - 1, 1),
    }


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAbBé 9.!?#\n\t-'", min_size=0, max_size=80))
def test_against_plain_counts(text):
    if text.split():
        assert dict(zip(STATISTICS, text_statistics(text))) == pytest.approx(plain(text))
    else:
        assert set(text_statistics(text)) == {0.0}


def test_long_texts_are_counted_whole():
    text = ("One two, three! " * 3 + "\n") * 20_000 + "LAST#"
    assert dict(zip(STATISTICS, text_statistics(text))) == pytest.approx(plain(text))
    assert text_statistics(None) == text_statistics("") == (0.0,) * len(STATISTICS)
