"""Operator 1: licence scan.

An Aho-Corasick automaton finds notice phrases and the identifier tag in one pass over the
word-normalised text; the expression behind a tag is turned into postfix order by a
shunting-yard parser (WITH binds tighter than AND, AND tighter than OR) and evaluated.

Defined results: null or empty text has no words, no labels and score 0; a null doc_id is
carried through; every input row gives one output row; other columns are ignored."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_document, plain_words

#: Phrases of the contract (words) and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notice phrases that this operator labels by itself.
NOTICE_PHRASES = {
    "mit license": "mit", "apache license": "apache", "bsd license": "bsd", "mozilla public license": "mpl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc0": "cc0", "public domain": "public-domain",
}
TAG = "spdx license identifier"
TAG_AT = re.compile(rb"(?i)spdx-license-identifier\s*:[ \t\"'#.;]*")
LINE_END = re.compile(rb"[\r\n]|\Z")
#: A bracket or a word of an expression; of a word only the beginning that an identifier may have counts.
TOKEN = re.compile(rb"[ \t\x0b\x0c]*(?:([()])|([\w.+:/\x80-\xff-]+))")
#: Licence family (prefix of an identifier) -> freedom of reuse, 0 to 1.
FREEDOM = {"cc0": 1.0, "unlicense": 1.0, "mit": 0.95, "bsd": 0.95, "isc": 0.95, "zlib": 0.95, "apache": 0.9,
           "cc-by-nc": 0.3, "cc-by-nd": 0.3, "cc-by-sa": 0.6, "cc-by": 0.8, "mpl": 0.6, "lgpl": 0.5,
           "agpl": 0.2, "gpl": 0.3}
#: How sure one piece of evidence of each kind makes the scan that the text carries a licence.
SURE_TAG, SURE_NOTICE, SURE_RESERVED = 0.95, 0.8, 0.5
BINDS = {"or": 1, "and": 2, "with": 3}
_SMALL = ("or", "and", "with")
_MAY_FOLLOW = (b"", b" ", b"\t", b"\x0b", b"\x0c", b"\r", b"\n", b"(", b")")


def leading(text: bytes, at: int) -> list[str] | None:
    """Shunting-yard: postfix order of the longest well-formed expression that starts at byte ``at`` and ends on
    its line; None where there is none. In running text a word may follow an operator that is no
    operator ("MIT and see below"): unless the line ends with the expression, one not in capitals
    counts only before a known licence or, for ``with``, an exception."""
    out: list[str] = []
    stack: list[str] = []
    best: tuple[int, list[str]] | None = None  # the last complete state: entries of out, stack
    operand_next, doubtful, operator, ended = True, False, "", False
    while not ended and (m := TOKEN.match(text, at)):
        at = m.end()
        token = (m[1] or m[2]).decode("utf-8", "replace")
        word = token.lower()
        if word == "(":
            if not operand_next:
                break
            stack.append(word)
            continue
        if word == ")":
            if operand_next or "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif word in BINDS:
            if operand_next:
                break
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[word]:
                out.append(stack.pop())
            stack.append(word)
            operand_next, operator = True, token
            continue
        else:
            name = word.rstrip(".:/-")
            if not operand_next or not name or name in BINDS:
                break
            ended = name != word or text[at:at + 1] not in _MAY_FOLLOW  # a mark ends the expression
            doubtful |= operator in _SMALL and not family(name) and not (operator == "with" and "exception" in name)
            out.append(name)
            operand_next = False
        if "(" not in stack and not doubtful:
            best = len(out), stack[:]
    complete = not operand_next and "(" not in stack
    if doubtful and complete and not text[at:LINE_END.search(text, at).start()].strip(b" \t.;#\"'*/->"):
        best = len(out), stack[:]
    return None if best is None else out[:best[0]] + best[1][::-1]


def family(identifier: str) -> str | None:
    found = [k for k in FREEDOM if identifier == k or identifier.startswith(f"{k}-")]
    return max(found, key=len) if found else None


def evaluate(order: list[str]) -> tuple[set[str], float]:
    """Labels named by a postfix expression and the freedom it grants: the licensee may choose
    at OR (largest), must obey both at AND (smallest); an exception eases its licence half way
    to full freedom. Unknown identifiers grant none but are labelled as written."""
    stack: list[tuple[set[str], float]] = []
    for token in order:
        if token in BINDS:
            (right, r), (left, l) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, (1 + l) / 2))
            else:
                stack.append((left | right, max(l, r) if token == "or" else min(l, r)))
        else:
            name = family(token)
            stack.append(({name or token}, FREEDOM.get(name, 0.0)))
    return stack[0]


def expressions(text: bytes) -> list[list[str]]:
    """The well-formed expressions behind the identifier tags of a text, in postfix order."""
    return [found for m in TAG_AT.finditer(text) if (found := leading(text, m.end()))]


@lru_cache
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase in {**BASE_PHRASES, **NOTICE_PHRASES, TAG: "tag"}:
        a.add_word(f" {phrase} ", phrase)
    a.make_automaton()
    return a


def scan_text(text: bytes | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expression, freedom."""
    words = plain_words(text)
    if not words:
        return 0, 0, None, None, "", "", 0.0, None, None
    flat = b" " + b" ".join(words) + b" "
    starts, base, labels, tagged, doubt = [], set(), set(), False, 1.0
    blanks = seen = 0  # blanks in front of byte ``seen``; hits come by ascending end
    for end, phrase in automaton().iter(flat.decode("latin-1")):
        if phrase in BASE_PHRASES:
            blanks += flat.count(b" ", seen, end + 1)
            seen = end + 1
            starts.append(blanks - flat.count(b" ", end - len(phrase) - 1, end + 1))
            base.add(BASE_PHRASES[phrase])
            doubt *= 1 - (SURE_RESERVED if phrase == "all rights reserved" else SURE_NOTICE)
        elif phrase == TAG:
            tagged = True
        else:
            labels.add(NOTICE_PHRASES[phrase])
            doubt *= 1 - SURE_NOTICE
    expression = freedom = None
    for order in expressions(text) if tagged else ():
        named, granted = evaluate(order)
        labels |= named
        doubt *= 1 - SURE_TAG
        freedom = granted if freedom is None else min(freedom, granted)
        expression = " ".join(order) if expression is None else expression
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), 1 - doubt, expression, freedom)


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, expression string, freedom double")


def license_scan(docs: DataFrame, keep: bool = False) -> DataFrame:
    """Scan every text; ``expression`` is the first well-formed tag expression in postfix
    order and ``freedom`` the least freedom any tag of the text grants (null without tags)."""
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string(), pa.float64()]

    def make():
        return lambda texts: [pa.array(c, k) for c, k in zip(zip(*map(scan_text, texts)), kinds)] if texts else [
            pa.array([], k) for k in kinds]

    return per_document(docs, SCHEMA, make, keep)
