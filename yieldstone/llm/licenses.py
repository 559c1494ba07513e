"""Licence tags and notices in whole texts.

One Aho-Corasick machine over the words of a text finds notice phrases and identifier tags. What follows a tag is a licence
expression: a shunting-yard parser puts it in postfix order, and it is evaluated with ``and`` as the stricter side, ``or``
as the freer one, and ``with`` as a licence that an exception loosens.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_slices, frugal

#: How freely a text under a licence can be used, from 0 (not at all) to 1.
FREE, FILE_COPYLEFT, COPYLEFT, NETWORK_COPYLEFT, NON_COMMERCIAL, CLOSED = 1.0, 0.6, 0.3, 0.2, 0.1, 0.0
#: The score of a text that says nothing about its licence.
SILENT = 0.5


@dataclass(frozen=True)
class Phrase:
    words: str
    label: str
    freedom: float
    base: bool = False


# Phrases that every scan looks for, with the labels that they stand for.
BASE_PHRASES = (
    Phrase("under the mit license", "mit", FREE, True),
    Phrase("apache license version 2", "apache-2", FREE, True),
    Phrase("cc by nc", "cc-by-nc", NON_COMMERCIAL, True),
)

# Further phrases of common notices.
NOTICE_PHRASES = (
    Phrase("permission is hereby granted free of charge", "mit", FREE),
    Phrase("redistribution and use in source and binary forms", "bsd", FREE),
    Phrase("permission to use copy modify and or distribute this software", "isc", FREE),
    Phrase("this is free and unencumbered software released into the public domain", "unlicense", FREE),
    Phrase("dedicated to the public domain", "public-domain", FREE),
    Phrase("cc0 1 0 universal", "cc0", FREE),
    Phrase("cc by 4 0", "cc-by", FREE),
    Phrase("cc by sa", "cc-by-sa", COPYLEFT),
    Phrase("cc by nd", "cc-by-nd", NON_COMMERCIAL),
    Phrase("creative commons attribution noncommercial", "cc-by-nc", NON_COMMERCIAL),
    Phrase("creative commons attribution sharealike", "cc-by-sa", COPYLEFT),
    Phrase("mozilla public license", "mpl", FILE_COPYLEFT),
    Phrase("eclipse public license", "epl", FILE_COPYLEFT),
    Phrase("gnu lesser general public license", "lgpl", FILE_COPYLEFT),
    Phrase("gnu general public license", "gpl", COPYLEFT),
    Phrase("gnu affero general public license", "agpl", NETWORK_COPYLEFT),
    Phrase("all rights reserved", "all-rights-reserved", CLOSED),
)

# Tags that an expression follows; after the first an unknown expression is a finding as well.
TAGS = ("spdx-license-identifier", "license-expression", "license")

# Licence identifiers in lower case, without what says "only" or "or later".
IDENTIFIERS = {
    "mit": FREE, "mit-0": FREE, "apache-2.0": FREE, "apache-1.1": FREE, "bsd-2-clause": FREE, "bsd-3-clause": FREE,
    "0bsd": FREE, "isc": FREE, "zlib": FREE, "unlicense": FREE, "cc0-1.0": FREE, "bsl-1.0": FREE, "psf-2.0": FREE,
    "python-2.0": FREE, "artistic-2.0": FREE, "wtfpl": FREE, "ncsa": FREE, "postgresql": FREE, "ofl-1.1": FREE,
    "mpl-1.1": FILE_COPYLEFT, "mpl-2.0": FILE_COPYLEFT, "epl-1.0": FILE_COPYLEFT, "epl-2.0": FILE_COPYLEFT,
    "cddl-1.0": FILE_COPYLEFT, "lgpl-2.0": FILE_COPYLEFT, "lgpl-2.1": FILE_COPYLEFT, "lgpl-3.0": FILE_COPYLEFT,
    "gpl-1.0": COPYLEFT, "gpl-2.0": COPYLEFT, "gpl-3.0": COPYLEFT, "eupl-1.2": COPYLEFT, "agpl-3.0": NETWORK_COPYLEFT,
}

# Exceptions that may follow "with".
EXCEPTIONS = (
    "autoconf-exception-3.0", "bison-exception-2.2", "bootloader-exception", "classpath-exception-2.0", "font-exception-2.0",
    "gcc-exception-2.0", "gcc-exception-3.1", "linux-syscall-note", "llvm-exception", "openjdk-assembly-exception-1.0",
)

#: Licences that a base phrase has a label for.
_LABELS = {"apache-2.0": "apache-2"}
_CREATIVE = re.compile(r"cc-by(-nc)?(-sa|-nd)?-[1-4]\.[0-9]")
_LATER = re.compile(r"(.+?)(?:\+|-only|-or-later)")
_OWN_NAME = re.compile(r"(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")


def licence(name: str) -> tuple[str, float] | None:
    """Label and freedom of an identifier in lower case, None for an unknown one."""
    later = _LATER.fullmatch(name)
    plain = later.group(1) if later and name not in IDENTIFIERS else name
    if plain in IDENTIFIERS:
        return _LABELS.get(plain, name), IDENTIFIERS[plain]
    if made := _CREATIVE.fullmatch(plain):
        if made.group(1):
            return "cc-by-nc" + (made.group(2) or ""), NON_COMMERCIAL
        return plain, {None: FREE, "-sa": COPYLEFT, "-nd": NON_COMMERCIAL}[made.group(2)]
    return (name, CLOSED) if _OWN_NAME.fullmatch(name) else None


#: How tightly operators bind.
BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9](?:[A-Za-z0-9.+:-]*[A-Za-z0-9+])?)")


def expression_tokens(data: bytes, at: int) -> Iterator[tuple[str, int]]:
    """Tokens in lower case from a place on, with their ends, up to what can't be part of an expression."""
    while token := _TOKEN.match(data, at):
        at = token.end()
        yield token.group(1).decode().lower(), at


def read_expression(tokens: Iterable[tuple[str, int]]) -> tuple[list[str], int]:
    """The longest well-formed expression that the tokens begin with, and its end; no tokens and 0 without one.

    Names must be known, an exception stands after ``with`` and a single name before it.
    """
    read: list[str] = []
    best, end, depth, wants_name = 0, 0, 0, True
    for token, stop in tokens:
        if wants_name:
            after_with = bool(read) and read[-1] == "with"
            if token == "(" and not after_with:
                depth += 1
            elif token in EXCEPTIONS if after_with else token not in BINDS and licence(token):
                wants_name = False
            else:
                break
        elif token == ")" and depth:
            depth -= 1
        elif token in BINDS and (token != "with" or (read[-1] != ")" and (len(read) < 2 or read[-2] != "with"))):
            wants_name = True
        else:
            break
        read.append(token)
        if not wants_name and not depth:
            best, end = len(read), stop
    return read[:best], end


def postfix(tokens: Sequence[str]) -> list[str]:
    """A well-formed expression with operators after their operands."""
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif token in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            out.append(token)
    return out + waiting[::-1]


def evaluate(tokens: Sequence[str]) -> tuple[list[str], float]:
    """Labels of the licences in a postfix expression, in their order, and its freedom."""
    labels: list[str] = []
    values: list[float] = []
    for token in tokens:
        if token == "with":
            values.pop()
            values[-1] = (1 + values[-1]) / 2
            exception = labels.pop()
            labels[-1] += f"-with-{exception}"
        elif token in BINDS:
            right = values.pop()
            values[-1] = min(values[-1], right) if token == "and" else max(values[-1], right)
        else:
            label, value = licence(token) or (token, 0.0)  # an exception has no freedom of its own
            labels.append(label)
            values.append(value)
    return labels, values[0]


#: Bytes of words, A to Z in lower case, all others as blanks; bytes from 128 on belong to letters.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_AFTER_TAG = re.compile(rb"[ \t\"']*[:=][ \t\"']*")


class Scanner:
    """Finds phrases and tags in UTF-8 text. A phrase is told by its words, whatever stands between them."""

    def __init__(self, phrases: Sequence[Phrase]):
        import ahocorasick

        self.machine, self.found = ahocorasick.Automaton(), {}
        for phrase in phrases:
            self.found.setdefault(self._key(phrase.words), []).append(phrase)
        for tag in TAGS:
            self.found.setdefault(self._key(tag), []).append(tag)
        for key, what in self.found.items():
            self.machine.add_word(key, (len(key), what))
        self.machine.make_automaton()

    @staticmethod
    def _key(words: str) -> str:
        return f" {' '.join(x.decode('latin-1') for x in words.encode().translate(_WORD_BYTES).split())} "

    def __call__(self, data: bytes) -> tuple[int, list[dict]]:
        """Number of words, and the findings by their first word."""
        flat = data.translate(_WORD_BYTES)
        words = flat.split()
        line = f" {b' '.join(words).decode('latin-1')} "  # one character a byte
        hits = [(end - size + 1, what) for end, (size, what) in self.machine.iter(line)]
        if not hits:
            return len(words), []
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        first = np.searchsorted(blanks, [at for at, _ in hits]).tolist()
        kept = np.frombuffer(b" " + flat + b" ", np.uint8) != 32
        edges = np.flatnonzero(kept[1:] != kept[:-1])
        findings = []
        for word, (_, whats) in sorted(zip(first, hits, strict=True), key=lambda x: x[0]):
            for what in whats:
                if isinstance(what, Phrase):
                    kind = "base" if what.base else "notice"
                    findings.append(dict(kind=kind, word=word, said=what.words, labels=[what.label], freedom=what.freedom))
                elif tagged := self._after(what, data, edges[2 * word], edges[2 * (word + what.count("-")) + 1]):
                    findings.append(tagged | dict(kind="tag", word=word))
        return len(words), findings

    @staticmethod
    def _after(tag: str, data: bytes, start: int, end: int) -> dict | None:
        """The expression after a tag that fills the bytes from start to end."""
        mark = _AFTER_TAG.match(data, end)
        if mark is None or data[start:end].lower() != tag.encode():
            return None
        tokens, stop = read_expression(expression_tokens(data, mark.end()))
        if tokens:
            labels, freedom = evaluate(postfix(tokens))
            return dict(said=data[mark.end() : stop].decode(), labels=labels, freedom=freedom)
        return dict(said="", labels=["unknown"], freedom=CLOSED) if tag == TAGS[0] else None


#: Findings of a text: kind (base, notice or tag), first word (from 0), phrase or expression, labels, freedom.
FINDING = pa.struct(
    [("kind", pa.string()), ("word", pa.int64()), ("said", pa.string()), ("labels", pa.list_(pa.string())), ("freedom", pa.float64())]
)


def scan_licences(docs: DataFrame, ident: str = "doc_id", text: str = "text", phrases: Sequence[Phrase] = BASE_PHRASES + NOTICE_PHRASES) -> DataFrame:
    """``ident``, ``n_words`` and ``findings`` of every row's whole text, the findings by their first word.

    No row is moved, so a key with any share of the rows does no harm. A null or empty text has no words and no findings;
    repeated rows each get their result; texts of any length are read whole, one at a time; an empty table gives an
    empty result; other columns aren't read. Phrases that share words or overlap are all found.
    """
    kind = dict(docs.dtypes)[ident]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases)
        for part in byte_slices(batches, 1):
            found = [scanner(x or b"") for x in part[1].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part[0], pa.array([n for n, _ in found], pa.int64()), pa.array([f for _, f in found], pa.list_(FINDING))],
                ["ident", "n_words", "findings"],
            )

    rows = docs.select(docs[ident].alias("ident"), docs[text].cast("binary"))
    finding = "array<struct<kind: string, word: long, said: string, labels: array<string>, freedom: double>>"
    return rows.mapInArrow(frugal(run), f"ident {kind}, n_words long, findings {finding}").withColumnRenamed("ident", ident)
