"""License scans: one Aho-Corasick pass finds notice phrases and identifier tags, a shunting-yard parser evaluates tags' expressions.

A text becomes words (A-Z in lower case; digits, letters and every byte from
0x80 on; all else separates), joined by one space, and the automaton runs
over all of it. Phrases match whole words only. A tag is followed by an
expression, `ID (AND|OR|WITH) ID` with parentheses, read up to the line's
end; it gives the labels of its identifiers and whether it allows use
under `permissive` licences: AND needs both sides, OR one, WITH keeps its
left side's answer.

score: how sure the licence is; 0 without evidence, 0.5 for a notice phrase
alone, 0.8 for two agreeing kinds of evidence, 1 for a tag that parses. It
is 0.2 less where a restrictive label stands beside permissive ones.

Nulls and odd input: a null or empty text has no words and no labels
(empty strings, score 0). A null doc_id stays null. Rows are judged one by
one, so repeats get equal rows. Broken expressions give no label. Extra
columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ALNUM, table

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notice phrases that the method adds.
NOTICES = {
    "apache software license": "apache",
    "bsd license": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: Heads of identifiers and their labels, the longest first.
IDENTIFIERS = (
    ("cc-by-nc-sa", "cc-by-nc-sa"), ("cc-by-nc-nd", "cc-by-nc-nd"), ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"), ("cc-by-sa", "cc-by-sa"), ("cc-by", "cc-by"),
    ("cc0", "cc0"), ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("apache", "apache"), ("bsd", "bsd"), ("mit", "mit"), ("mpl", "mpl"), ("epl", "epl"), ("isc", "isc"),
    ("unlicense", "unlicense"), ("zlib", "zlib"), ("eupl", "eupl"), ("bsl", "bsl"), ("artistic", "artistic"), ("ofl", "ofl"),
)
PERMISSIVE = frozenset({"mit", "apache", "bsd", "isc", "cc0", "cc-by", "public-domain", "unlicense", "zlib", "bsl"})
RESTRICTIVE = frozenset({"proprietary", "cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd"})
_RANK = {"or": 1, "and": 2, "with": 3}
_TAG_LINE = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+\-]*")


def identifier(token: str) -> str | None:
    t = token.lower()
    return next((label for head, label in IDENTIFIERS if t == head or t.startswith((head + "-", head + ".", head + "+"))), None)


def parse(expression: str, permissive: frozenset = PERMISSIVE) -> tuple[set, bool] | None:
    """(labels, allowed) of an expression; None where it is broken. Operators wait on a stack by rank."""
    values: list[tuple[set, bool]] = []
    waiting: list[str] = []

    def apply() -> bool:
        op = waiting.pop()
        if op == "(" or len(values) < 2:
            return False
        (b, b_ok), (a, a_ok) = values.pop(), values.pop()
        values.append((a, a_ok) if op == "with" else (a | b, (a_ok and b_ok) if op == "and" else (a_ok or b_ok)))
        return True

    operand = True  # what may come next
    for token in _TOKEN.findall(expression):
        word = token.lower()
        if word == "(":
            if not operand:
                return None
            waiting.append(word)
        elif word == ")":
            while waiting and waiting[-1] != "(":
                if not apply():
                    return None
            if operand or not waiting:
                return None
            waiting.pop()
        elif word in _RANK:
            if operand:
                return None
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[word]:
                if not apply():
                    return None
            waiting.append(word)
            operand = True
        elif not operand:
            break  # prose after the expression
        else:
            label = identifier(token)
            values.append(({label} if label else set(), label in permissive))
            operand = False
    while waiting:
        if not apply():
            return None
    return values[0] if len(values) == 1 and not operand else None


def automaton() -> ahocorasick.Automaton:
    """Phrases between spaces, over text whose bytes are read as Latin-1."""
    found = ahocorasick.Automaton()
    for phrase in {**NOTICES, **BASE, TAG: None}:
        found.add_word(f" {phrase} ", (phrase, BASE.get(phrase), NOTICES.get(phrase), len(phrase) + 2))
    found.make_automaton()
    return found


def scan(text: str | None, found: ahocorasick.Automaton, permissive: frozenset = PERMISSIVE) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, allowed."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(ALNUM).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts, base, longest, tagged, spaces = [], set(), {}, False, None
    for end, (phrase, base_label, label, length) in found.iter(line):
        if base_label:
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            starts.append(int(np.searchsorted(spaces, end - length + 1)))
            base.add(base_label)
        elif label:
            longest[end - length] = label  # of phrases with one start the longest ends last
        else:
            tagged = True
    allowed, extra = None, set(longest.values())
    parsed = [p for m in _TAG_LINE.finditer(text) if (p := parse(m[1], permissive))] if tagged else []
    named = set().union(*(p[0] for p in parsed)) if parsed else set()
    labels = base | extra | named
    if parsed:
        allowed = all(ok for _, ok in parsed)
    elif labels:
        allowed = labels <= permissive
    score = 1.0 if named else 0.8 if base and extra else 0.5 if labels else 0.0
    if labels & RESTRICTIVE and labels & permissive:
        score -= 0.2
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 6), allowed,
    )


FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("allowed", pa.bool_())]
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, allowed boolean"


def license_scan(docs: DataFrame, permissive: frozenset = PERMISSIVE) -> DataFrame:
    """docs: doc_id, text. One row a document, in one pass over the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in batches:
            rows = [scan(t.as_py(), found, permissive) for t in batch.column("text")]
            columns = zip(*rows, strict=True) if rows else [[] for _ in FIELDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(list(c), kind) for c, (_, kind) in zip(columns, FIELDS, strict=True))], ["doc_id", *(n for n, _ in FIELDS)]
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
