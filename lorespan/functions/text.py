"""Text expressions: tokens, prompts, abbreviations, refusals.

Every character class is spelled out. ``\\s``, ``\\w`` and ``\\b`` mean different sets in different
regular-expression engines; explicit classes mean the same set everywhere.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lorespan import fixed_values as fixed

WHITESPACE = r"[ \t\n\x0B\f\r]"
WHITESPACE_TOKEN = r"[^ \t\n\x0B\f\r]+"
CHARACTER_TOKEN = r"(?s)."
WORD = r"[\p{L}\p{N}]+"
WORD_OR_GAP = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
#: One or more words with what lies between them.
ENTRY = r"[\p{L}\p{N}_]+(?:[^\p{L}\p{N}_]+[\p{L}\p{N}_]+)*"
SENTENCE = r"[^.!?。！？\n]+"


def tokens(text: Column, mode: str = "ws") -> Column:
    """Tokens of a text: white-space runs (``ws``) or single code points (``char``)."""
    return F.regexp_extract_all(text, F.lit(_token_pattern(mode)), F.lit(0))


def has_token(text: Column, mode: str = "ws") -> Column:
    return text.rlike(_token_pattern(mode))


_MODES = {"ws": WHITESPACE_TOKEN, "char": CHARACTER_TOKEN}


def check_mode(mode: str) -> None:
    if mode not in _MODES:
        raise ValueError(f"unknown token mode {mode!r}")


def _token_pattern(mode: str) -> str:
    check_mode(mode)
    return _MODES[mode]


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


# -- abbreviations ------------------------------------------------------------------------------


def word_runs(text: str) -> list[str]:
    """Runs of word characters and of others, as the expressions cut them."""
    import regex

    return regex.findall(WORD_OR_GAP, text)


class RunTrie:
    """Entries of one or more words by their runs, in lower case."""

    _END = None  # no run

    def __init__(self, entries: Iterable[tuple[str, object]]) -> None:
        self.root: dict = {}
        for entry, value in entries:
            node = self.root
            for run in word_runs(entry.lower()):
                node = node.setdefault(run, {})
            node[self._END] = value

    def matches(self, text: str, counts: Callable[[object], bool] | None = None) -> Iterator[tuple[int, int, object]]:
        """(first run, number of runs, value) of the longest entry at every run of ``text`` that begins one."""
        return self.matches_in([run.lower() for run in word_runs(text)] if self.root else [], counts)

    def matches_in(
        self, runs: Sequence[str], counts: Callable[[object], bool] | None = None, places: Iterable[int] | None = None
    ) -> Iterator[tuple[int, int, object]]:
        """The same in a text that is cut already, in lower case; at ``places`` only, if given."""
        for at in range(len(runs)) if places is None else places:
            node, end, best = self.root.get(runs[at]), at + 1, None
            while node is not None:
                if self._END in node and (counts is None or counts(node[self._END])):
                    best = (at, end - at, node[self._END])
                node = node.get(runs[end]) if end < len(runs) else None
                end += 1
            if best is not None:
                yield best


def leftmost(matches: Iterable[tuple[int, int, object]]) -> list[tuple[int, int, object]]:
    """Sorted matches without those that overlap one before."""
    out, free = [], 0
    for match in matches:
        if match[0] >= free:
            out.append(match)
            free = match[0] + match[1]
    return out


def splice(text: str, matches: Iterable[tuple[int, int, str]]) -> str:
    """``text`` with the runs of each match replaced by its value; matches are sorted and don't overlap."""
    return splice_runs(word_runs(text), matches)


def splice_runs(runs: list[str], matches: Iterable[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for first, count, value in matches:
        out += [*runs[at:first], value]
        at = first + count
    return "".join([*out, *runs[at:]])


def expansion_table(abbreviations: Mapping[str, str]) -> dict[str, str]:
    """Lower-cased abbreviation -> final replacement.

    An abbreviation is one or more words. Entries apply in dictionary order: a replacement, ``abbreviation (full text)``,
    may itself contain a later abbreviation, which is replaced in turn. Following those chains here, once, over the
    dictionary alone, lets a single pass over the data give the same text. Where entries overlap, the leftmost counts and
    of those at one place the longest.
    """
    import regex

    keys = list(abbreviations)
    if any(not regex.fullmatch(ENTRY, key) for key in keys):
        raise ValueError("an abbreviation has to begin and end with a word")
    if len({key.lower() for key in keys}) != len(keys):
        raise ValueError("abbreviations have to differ in more than case")
    table: dict[str, str] = {}
    for key in reversed(keys):
        whole = f"{key} ({abbreviations[key]})"
        table[key.lower()] = splice(whole, leftmost(RunTrie(table.items()).matches(whole)))
    return table


def expand_abbreviations(text: Column, abbreviations: Mapping[str, str] | None = None) -> Column:
    """Replace abbreviations, ignoring case: ``ml`` -> ``ML (Machine Learning)``.

    The text is cut into word and non-word runs, so word boundaries follow letters and digits of any
    script. Apply exactly once: the replacement contains the abbreviation again.
    """
    table = expansion_table(fixed.ABBREVIATIONS if abbreviations is None else abbreviations)
    return replace_entries(text, table) if table else text


def replace_entries(text: Column, table: Mapping[str, str]) -> Column:
    """Entries of ``table`` (lower-cased, one or more words) replaced in one pass over the text.

    Entries of several words are alternatives of the pattern that cuts the text, the longest first, so each comes out as
    one piece and the leftmost and longest counts. What a place costs does not grow with the number of entries.
    """
    long = [k for k in table if len(word_runs(k)) > 1]
    if not long and len(table) <= LOOKUP_PARTS:
        return replace_words(text, map_literal(table))
    pattern = "(?iu)(?:" + prefix_tree_pattern(long) + r")(?![\p{L}\p{N}_])|" + WORD_OR_GAP if long else WORD_OR_GAP
    pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lookup = _lookup(table)
    return F.array_join(F.transform(pieces, lambda piece: F.coalesce(lookup(F.lower(piece)), piece)), "")


def prefix_tree_pattern(keys: Iterable[str]) -> str:
    """A pattern of all keys, the longest first, in which alternatives share their beginnings.

    The engine tries alternatives one by one, so at a place it tries the letters that can come next rather than all keys. Letters
    that are equal without regard to case are one.
    """
    root: dict = {}
    for key in keys:
        node = root
        for letter in key:
            folded = letter.upper().lower()
            node = node.setdefault(folded if len(folded) == 1 else letter, {})
        node[None] = {}

    def pattern(node: dict) -> str:
        chain = ""
        while len(node) == 1 and None not in node:
            ((letter, node),) = node.items()
            chain += re.escape(letter)
        ways = [re.escape(letter) + pattern(below) for letter, below in sorted(kv for kv in node.items() if kv[0] is not None)]
        if not ways:
            return chain
        return f"{chain}(?:{'|'.join(ways)}){'?' if None in node else ''}"

    return pattern(root)


#: A map literal is searched entry by entry: larger tables are dealt to so many of them by a checksum of the key.
LOOKUP_PARTS = 32


def _lookup(table: Mapping[str, str]) -> Callable[[Column], Column]:
    """A column function: the value of a key, or null."""
    if len(table) <= LOOKUP_PARTS:
        whole = map_literal(table)
        return lambda key: F.try_element_at(whole, key)
    count = max(LOOKUP_PARTS, len(table) // 2)
    parts: list[dict[str, str]] = [{} for _ in range(count)]
    for key, value in table.items():
        parts[zlib.crc32(key.encode()) % count][key] = value
    maps = F.array(*[map_literal(part) for part in parts])
    return lambda key: F.try_element_at(F.get(maps, (F.crc32(key.cast("binary")) % count).cast("int")), key)


def map_literal(table: Mapping[str, str]) -> Column:
    if not table:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(part) for pair in table.items() for part in pair])


def replace_words(text: Column, lookup: Column) -> Column:
    """Whole words replaced by what a map has for their lower-cased form, in one pass over the text."""
    runs = F.regexp_extract_all(text, F.lit(WORD_OR_GAP), F.lit(0))
    return F.array_join(F.transform(runs, lambda run: F.coalesce(F.try_element_at(lookup, F.lower(run)), run)), "")


def plain_words(text: Column) -> Column:
    """Lower-cased word runs, as ``replace_words`` looks them up."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


# -- prompts ------------------------------------------------------------------------------------


def render_template(template: str, **slots: Column) -> Column:
    """Fill ``{name}`` slots.

    The template is split once, on the driver; slot values are only concatenated, never searched, so
    a value that contains ``{question}`` or ``$1`` stays as it is.
    """
    pieces = re.split(r"\{(\w+)\}", template)
    missing = set(pieces[1::2]) - set(slots)
    if missing:
        raise ValueError(f"no value for {sorted(missing)}")
    parts = [slots[piece] if at % 2 else F.lit(piece) for at, piece in enumerate(pieces) if at % 2 or piece]
    return F.concat(*parts)


def question_prompt(context: Column, question: Column, organisation: str, template: str | None = None) -> Column:
    slots = {"context": context, "question": question}
    template = fixed.QUESTION_TEMPLATE if template is None else template
    if "{organisation}" in template:
        slots["organisation"] = F.lit(organisation)
    return render_template(template, **slots)


def instruction_prompt(instruction: Column, context: Column | None = None) -> Column:
    """Training prompt; the input block appears only where the context is neither null nor empty."""
    head = [fixed.PROMPT_INTRO, "", fixed.INSTRUCTION_MARK, "{instruction}", ""]
    tail = [fixed.RESPONSE_MARK]
    plain = render_template("\n".join(head + tail), instruction=instruction)
    if context is None:
        return plain
    block = [fixed.INPUT_MARK, "{context}", ""]
    full = render_template("\n".join(head + block + tail), instruction=instruction, context=context)
    return F.when(F.coalesce(context, F.lit("")) != "", full).otherwise(plain)


def training_text(prompt: Column, response: Column) -> Column:
    """Prompt and response in one string. Looks like a dictionary, but nothing in it is escaped."""
    return render_template("{ 'prompt': {prompt}, 'response': {response} }", prompt=prompt, response=response)


def serving_prompt(instruction: Column) -> Column:
    """Prompt of the tuned model: every line after the first is indented, the last one is only indent."""
    gap = "\n" + " " * fixed.SERVING_INDENT
    lines = [fixed.PROMPT_INTRO, fixed.INSTRUCTION_MARK, "{instruction}", fixed.RESPONSE_MARK, ""]
    return render_template(gap.join(lines), instruction=instruction)


def reply_message(answer: Column, source: Column) -> Column:
    """Chat reply. A missing part shows as ``None`` rather than emptying the whole message."""
    shown = [F.coalesce(part, F.lit("None")) for part in (answer, source)]
    return F.concat(shown[0], F.lit(".  \n Source: "), shown[1])


# -- answers ------------------------------------------------------------------------------------


def is_good_answer(answer: Column, phrases: Sequence[str] | None = None) -> Column:
    """True unless the answer is null or contains, in lower case, one of the phrases. Never null."""
    phrases = fixed.REFUSAL_PHRASES if phrases is None else phrases
    lowered = F.lower(answer)
    if not phrases:
        return answer.isNotNull()
    # One predicate whatever the number of phrases, and one evaluation of the lower-cased text for all.
    one = F.exists(F.array(lowered), lambda text: F.exists(F.array(*[F.lit(p) for p in phrases]), lambda phrase: text.contains(phrase)))
    return answer.isNotNull() & ~F.coalesce(one, F.lit(True))


# -- names --------------------------------------------------------------------------------------


def qualified_name(catalog: Column, schema: Column, name: Column) -> Column:
    return F.concat_ws(".", catalog, schema, name)


def version_uri(name: Column, alias: Column) -> Column:
    return F.concat(F.lit("models:/"), name, F.lit("@"), alias)
