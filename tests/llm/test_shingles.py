import numpy as np
import pyarrow as pa
from helpers import LONG, LOWER, WORDS, shingles
from hypothesis import given, settings
from hypothesis import strategies as st

from lorespan.llm import decontaminate
from lorespan.llm.shingles import shingle_sets, string_parts, window_hashes, word_hashes

TEXT = st.text(alphabet="aAbZz \n\t\x0b\x1c09é-.ß　", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_sets_have_the_sizes_and_overlaps_of_word_tuples(texts):
    got = dict(shingle_sets(pa.array(texts, pa.string())))
    want = [shingles(t) for t in texts]
    assert [len(got.get(k, ())) for k in range(len(texts))] == [len(s) for s in want]
    for i, a in enumerate(want):
        for j, b in enumerate(want):
            assert len(np.intersect1d(got[i], got[j])) == len(a & b)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words_are_split_by_the_given_separators(texts):
    import re

    data, offsets = string_parts(pa.array(texts, pa.string()))
    words, bounds, _, _ = word_hashes(data, offsets, decontaminate.SEPARATORS)
    rule = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    want = [rule.findall(t.translate(LOWER)) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    same = {}
    for word, value in zip(flat, words.tolist()):
        assert same.setdefault(word, value) == value
    assert len(set(same.values())) == len(same)


def test_slices_long_texts_and_lower_case():
    column = pa.array(["skip", "One two THREE four five six", LONG, "one TWO three four five SIX"]).slice(1)
    got = dict(shingle_sets(column))
    assert got[0].tolist() == got[2].tolist() and len(got[0]) == 2
    assert len(got[1]) == len(shingles(LONG))
    assert len(WORDS.findall(LONG)) == 100_000
    assert len(window_hashes(np.zeros(3, np.uint64), 5)) == 0


def parity_words(n):
    """A word of a and b by the parity of the bits of the position, and its swap: equal for any polynomial modulo 2**64."""
    letters = ["ab"[bin(k).count("1") & 1] for k in range(n)]
    return "".join(letters), "".join("ba"[c == "b"] for c in letters)


def test_parity_words_differ():
    for n in (16, 64, 256, 1024, 2048, 4096):
        pair = parity_words(n)
        assert pair[0] != pair[1] and len(pair[0]) == len(pair[1]) == n
        got = dict(shingle_sets(pa.array(pair)))
        assert got[0].tolist() != got[1].tolist()


def test_words_of_all_lengths_have_hashes_of_their_own():
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("abcdeXYZ019"), n)) for n in range(1, 200) for _ in range(20)} | {"a" * n for n in range(1, 300)})
    data, offsets = string_parts(pa.array([" ".join(words)]))
    hashes, bounds, starts, ends = word_hashes(data, offsets)
    assert bounds.tolist() == [0, len(words)] and (ends - starts).tolist() == [len(w) for w in words]
    assert len(np.unique(hashes)) == len({w.lower() for w in words})
    alone = [word_hashes(*string_parts(pa.array(["x " + w])))[0][1] for w in words[::50]]
    assert alone == hashes[::50].tolist()


def test_pieces_do_not_change_a_text():
    from lorespan.llm import shingles

    text = " ".join(f"Word{k % 977} {'long' * (k % 40)}" for k in range(4000))
    data, offsets = string_parts(pa.array([text, "next text", text[:5000]]))
    whole = word_hashes(data, offsets)
    for limit in (7, 64, 1000):
        parts = list(shingles.word_pieces(data, offsets, limit=limit))
        assert all(np.array_equal(np.concatenate(x), y) for x, y in zip(zip(*parts), (whole[0], whole[2], whole[3])))


def test_a_very_long_text_takes_bounded_space():
    """100 MB of words in 500 MB: counted in a process of its own."""
    import subprocess
    import sys

    code = """
import resource, numpy as np, pyarrow as pa
from lorespan.llm.shingles import shingle_sets
from lorespan.llm.decontaminate import texts_of
unit = " ".join(f"w{k}" for k in range(200_000)) + " "
text = pa.array([unit * (100_000_000 // len(unit))])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
sizes = [len(s) for _, s in shingle_sets(text)]
words = sum(len(w) for _, w, _ in texts_of(text))
used = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
print(sizes[0], words, int(used))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=str(__import__("pathlib").Path(__file__).resolve().parents[2]))
    distinct, words, used = map(int, out.stdout.split())
    assert 200_000 <= distinct <= 200_010 and words > 13_000_000 and used < 400
