"""Frames with the odd rows every operator has to take, and plain versions of word and set rules."""

import re

LONG = "lorem ipsum dolor sit amet " * 20_000
WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def odd_documents(spark, texts=()):
    """Null id, null, empty, blank and very long texts, ties, repeated rows and extra columns with clashing names."""
    rows = [(k, t) for k, t in enumerate(texts)]
    base = len(rows)
    rows += [(base, None), (base + 1, ""), (base + 2, " \n\t"), (base + 3, LONG), (base + 4, "same text of some words here"), (base + 5, "same text of some words here")]
    rows += [rows[-1], (None, "a row without an id but with words"), (None, None)]
    full = [(i, t, None if i is None else f"src{i % 3}", "en", None if t is None else len(t), 7, "x", 1.0) for i, t in rows]
    schema = "doc_id long, text string, source string, lang string, n_chars long, component_id long, slot string, score double"
    return spark.createDataFrame(full, schema), rows


def shingles(text, width=5):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(len(words) - width + 1, 1)))
