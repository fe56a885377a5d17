"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags; tagged expressions are parsed.

A text is lower-cased (A-Z) and cut into words of digits, letters and non-ASCII characters. Words joined by single
spaces are matched against all phrases at once, whole words only. ``SPDX-License-Identifier:`` tags are found in the
text itself; the expression after a tag goes through a shunting-yard parser for AND, OR and WITH.

Defined cases: a null text is empty and has no label; overlapping places of base phrases all count, of overlapping notices
only the longest; a text of any length is scanned whole, in memory in proportion; a malformed expression keeps the
identifiers it names and permits nothing; extra columns are ignored; repeated rows are scanned each; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ALNUM

#: The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notice phrases that the method adds, besides those of ``creative_commons``; of overlapping phrases the longest counts.
NOTICE_PHRASES = {
    "all rights reserved": "proprietary",
    "proprietary and confidential": "proprietary",
    "confidential and proprietary": "proprietary",
    "mit license": "mit",
    "mit no attribution": "mit-0",
    "permission is hereby granted free of charge": "mit",
    "x11 license": "x11",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "apache license": "apache",
    "apache license version 1": "apache-1",
    "apache license 2": "apache-2",
    "apache license version 2": "apache-2",
    "boost software license": "bsl",
    "zlib license": "zlib",
    "this is free and unencumbered software": "unlicense",
    "the unlicense": "unlicense",
    "do what the fuck you want to public license": "wtfpl",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "microsoft public license": "ms-pl",
    "microsoft reciprocal license": "ms-rl",
    "artistic license": "artistic",
    "academic free license": "afl",
    "open software license": "osl",
    "python software foundation license": "psf",
    "postgresql license": "postgresql",
    "sil open font license": "ofl",
    "server side public license": "sspl",
    "business source license": "busl",
    "elastic license": "elastic",
    "open data commons attribution license": "odc-by",
    "open database license": "odbl",
    "public domain dedication and license": "pddl",
    "creative commons zero": "cc0",
    "cc0 1 0 universal": "cc0",
}


def creative_commons() -> dict[str, str]:
    """Notice phrases of all attribution licences, by their long and short names, with the words' usual spellings."""
    terms = {
        "nc": ("noncommercial", "non commercial"), "sa": ("sharealike", "share alike"),
        "nd": ("noderivs", "noderivatives", "no derivs", "no derivatives"),
    }
    out = {}
    for extra in ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd")):
        label = "-".join(("cc", "by", *extra))
        for words in product(*(terms[t] for t in extra)):
            out[" ".join(("creative commons attribution", *words))] = label
        out[" ".join(("cc", "by", *extra))] = label
    return out


TAG = "spdx-license-identifier:"

#: Licence families: an identifier belongs to the longest that it equals or goes on from with a hyphen or dot.
FAMILIES = (
    "0bsd", "afl", "agpl", "apache", "apache-1", "apache-2", "artistic", "beerware", "blueoak", "bsd", "bsl", "busl", "cc-by", "cc-by-nc",
    "cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nd", "cc-by-sa", "cc-pddc", "cc0", "cddl", "cecill", "cecill-b", "cecill-c", "cpl", "curl", "ecl", "elastic", "epl",
    "eupl", "gfdl", "gpl", "hpnd", "isc", "json", "lgpl", "mit", "mit-0", "mpl", "ms-pl", "ms-rl", "mulanpsl", "ncsa", "odbl", "odc-by", "ofl",
    "openssl", "osl", "pddl", "postgresql", "psf", "python", "ruby", "sspl", "unicode", "unlicense", "upl", "vim", "w3c", "wtfpl", "x11", "zlib",
    "zpl",
)

#: Licences whose text may be kept: those that ask for no more than notices. Share-alike, copyleft, non-commercial and
#: no-derivatives licences are none of them.
PERMITTED = frozenset({
    "0bsd", "afl", "apache-1", "apache-2", "beerware", "blueoak", "bsd", "bsl", "cc-by", "cc-pddc", "cc0", "cecill-b", "curl", "ecl", "hpnd", "isc",
    "mit", "mit-0", "mpl", "mulanpsl", "ncsa", "odc-by", "pddl", "postgresql", "psf", "python", "unicode", "unlicense", "upl", "w3c", "wtfpl", "x11",
    "zlib", "zpl",
})

#: Exceptions that add permissions to a licence; another word after WITH changes its terms, so nothing is permitted.
EXCEPTIONS = (
    "autoconf-exception", "bison-exception", "bootloader-exception", "classpath-exception", "ecos-exception", "font-exception", "gcc-exception",
    "gnat-exception", "gstreamer-exception", "i2p-gpl-java-exception", "libtool-exception", "linux-syscall-note", "llvm-exception",
    "ocaml-lgpl-linking-exception", "openjdk-assembly-exception", "openssl-exception", "qt-gpl-exception", "qt-lgpl-exception", "swift-exception",
    "u-boot-exception", "universal-foss-exception", "wxwindows-exception",
)

PRECEDENCE = {"or": 1, "and": 2, "with": 3}

_TOKEN = re.compile(r"[()]|[a-z0-9.+\-:]+")
#: What may follow a tag: operators and parentheses chain identifiers, anything else ends the expression.
_NAME = r"(?:\([ \t]*)*[a-z0-9.+\-:]+(?:[ \t]*\))*"
_EXPRESSION = re.compile(rf"[ \t]*({_NAME}(?:[ \t]+(?:and|or|with)[ \t]+{_NAME})*)")


def _belongs(name: str, family_: str) -> bool:
    return name == family_ or name.startswith((f"{family_}-", f"{family_}."))


def family(identifier: str) -> str:
    """The label of a licence identifier, itself if no family holds it."""
    name = identifier.rstrip("+").rstrip(".")
    return max((f for f in FAMILIES if _belongs(name, f)), key=len, default=name)


def known_exception(identifier: str) -> bool:
    return any(_belongs(identifier, e) for e in EXCEPTIONS)


def postfix(expression: str) -> list[str] | None:
    """The expression's tokens in postfix order, None if it is malformed."""
    out, waiting, operand = [], [], True
    for token in _TOKEN.findall(expression):
        if token == "(":
            if not operand:
                return None
            waiting.append(token)
        elif token == ")":
            if operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif token in PRECEDENCE:
            if operand:
                return None
            while waiting and PRECEDENCE.get(waiting[-1], 0) >= PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def permits(expression: str, allowed: Iterable[str] = PERMITTED) -> bool:
    """Whether the licences in ``allowed`` satisfy the expression; a known exception leaves its licence as it is."""
    order = postfix(expression)
    stack: list[tuple[bool, str]] = []
    for token in order or ():
        if token not in PRECEDENCE:
            stack.append((family(token) in allowed, token))
            continue
        (right, name), (left, _) = stack.pop(), stack.pop()
        verdict = left or right if token == "or" else left and right if token == "and" else left and known_exception(name)
        stack.append((verdict, ""))
    return bool(stack) and stack[0][0]


def licence_names(expression: str) -> set[str]:
    """Labels of the licences an expression names; exceptions after WITH are none."""
    tokens, names = _TOKEN.findall(expression), set()
    for before, token in zip([""] + tokens, tokens, strict=False):
        if token not in PRECEDENCE and token not in "()" and before != "with":
            names.add(family(token))
    return names


def phrase_automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    phrases = NOTICE_PHRASES | creative_commons()
    for phrase in phrases | BASE_PHRASES:
        machine.add_word(f" {phrase} ", (len(phrase) + 1, phrases.get(phrase), BASE_PHRASES.get(phrase)))
    machine.make_automaton()
    return machine


def tag_automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    machine.add_word(TAG, TAG)
    machine.make_automaton()
    return machine


#: Bytes as they are matched: A-Z folded, everything outside words a space.
_WORD_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if ALNUM[b] or 65 <= b <= 90 else 32 for b in range(256))
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, expressions array<string>, permitted boolean"
)


def scan_text(text: str, phrases: ahocorasick.Automaton, tags: ahocorasick.Automaton, allowed: frozenset[str] = PERMITTED) -> tuple:
    """The columns of ``SCHEMA`` but doc_id for one text."""
    data = text.encode()
    words = data.translate(_WORD_BYTES).split()
    joined = b" ".join([b"", *words, b""]).decode()
    base, starts, n_base, notices = set(), [], 0, []
    for end, (size, label, base_label) in phrases.iter(joined):
        if label is not None:
            while notices and notices[-1][0] >= end - size:  # a longer phrase that ends here holds it
                notices.pop()
            if not notices or notices[-1][1] < end:
                notices.append((end - size, end, label))
        if base_label is not None:
            n_base += 1
            base.add(base_label)
            starts.append(end - size)
    labels = base | {label for *_, label in notices}
    expressions = []
    if b":" in data:
        folded = data.translate(_FOLDED).decode()
        expressions = [m[1].strip() for end, _ in tags.iter(folded) if (m := _EXPRESSION.match(folded, end + 1))]
    for expression in expressions:
        labels |= licence_names(expression)
    permitted = (
        all(permits(e, allowed) for e in expressions) if expressions else labels <= allowed if labels else None
    )
    score = 0.0 if not labels else 1.0 if expressions else 0.9 if base else 0.7
    first, last = (joined.count(" ", 0, starts[0]), joined.count(" ", 0, starts[-1])) if starts else (None, None)
    return (
        len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, expressions, permitted,
    )


def scan_documents(docs: DataFrame, permitted: Iterable[str] = PERMITTED) -> DataFrame:
    """Licence labels of every row of ``docs`` (doc_id, text).

    Positions count words from 0; base columns tell of ``BASE_PHRASES`` alone. ``score`` is the strength of the best
    evidence (tag 1, base phrase 0.9, notice 0.7, none 0). The column permitted: all tagged expressions, or without tags
    all labels, are satisfied by the licences in ``permitted``; null without any label.
    """
    allowed = frozenset(permitted)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, tags = phrase_automaton(), tag_automaton()
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                found = [scan_text(t.as_py() or "", phrases, tags, allowed) for t in part.column(1)]
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True))], names=_NAMES
                )

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]
_TYPES = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.bool_()]
