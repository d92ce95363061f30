"""License scans by template-markup matching.

A template is licence wording with two kinds of regions::

    <<beginOptional>> words that may be missing <<endOptional>>
    <<var;LO-HI>>     any LO to HI words (a holder's name, a year)

Everything else is mandatory wording.  A template is compiled into a token automaton, a nondeterministic one whose set
of states is the bits of an integer; a text is accepted at a place if the mandatory words stand there exactly.  Words are
lower-cased (A-Z) runs of letters, digits and non-ASCII characters, compared by their 64-bit hashes.  Automata start only
where a template's first two mandatory words stand, which numpy finds over whole Arrow buffers.

Null and empty texts: no words, no labels, score 0.  The score is 1 if a template is accepted, 0.5 if only a phrase
stands in the text.  Repeated rows are answered each; only the two named columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_ALPHANUMERIC, arrays_batch, blocks, byte_class, hash_text, string_buffer, table, words_of

# Phrases and their labels, as the query's contract names them.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

_BSD_CLAUSES = """redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
    conditions are met: <<beginOptional>>1.<<endOptional>> redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> redistributions in binary form must reproduce the above copyright
    notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """ this software is provided by <<var;1-12>> as is and any express or implied warranties, including, but not limited to, the
    implied warranties of merchantability and fitness for a particular purpose are disclaimed. in no event shall <<var;1-12>> be liable for any
    direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or
    services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict
    liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility
    of such damage"""
#: Whole texts of the short licences, and the notices by which works name the others.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license <<beginOptional>>version<<endOptional>> 2.0",
    "gpl-3.0": "gnu general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> <<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 3 <<beginOptional>>or at your option any later version<<endOptional>>",
    "gpl-2.0": "gnu general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> <<beginOptional>>version<<endOptional>> 2 <<beginOptional>>or at your option any later version<<endOptional>>",
    "cc-by-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by <<beginOptional>>license<<endOptional>> 4.0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by nc <<beginOptional>>license<<endOptional>> 4.0",
    "cc-by-sa-4.0": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by sa <<beginOptional>>license<<endOptional>> 4.0",
    "mit-notice": "released under the <<beginOptional>>terms of the<<endOptional>> mit license",
    "mit-text": """permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the software), to deal in the software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit
        persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice and
        this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
        substantial portions of the software. the software is provided as is, without warranty of any kind, express or implied,
        including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.
        in no event shall <<var;2-12>> be liable for any claim, damages or other liability, whether in an action of contract, tort
        or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software""",
    "isc-text": """permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. the software is
        provided as is and <<var;1-8>> disclaims all warranties with regard to this software including all implied warranties of
        merchantability and fitness. in no event shall <<var;1-8>> be liable for any special, direct, indirect, or consequential damages or
        any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious
        action, arising out of or in connection with the use or performance of this software""",
    "bsd-2-clause": _BSD_CLAUSES + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD_CLAUSES + """ <<beginOptional>>3.<<endOptional>> neither the name of <<var;1-12>> nor the names of <<beginOptional>>its<<endOptional>>
        <<beginOptional>>the<<endOptional>> <<beginOptional>>copyright holder<<endOptional>> contributors may be used to endorse or promote products derived
        from this software without specific prior written permission.""" + _BSD_DISCLAIMER,
}


class Automaton:
    """States 0..n are places between tokens; bit i of a set says that place i is reached, and place n accepts."""

    def __init__(self, template: str) -> None:
        self.reads: dict[int, int] = {}
        self.any = 0
        self.skips: dict[int, int] = {}
        at, opened, head = 0, [], []
        for piece in re.split(r"(<<[^>]*>>)", template):
            if piece == "<<beginOptional>>":
                opened.append(at)
            elif piece == "<<endOptional>>":
                start = opened.pop()
                self.skips[start] = self.skips.get(start, 0) | 1 << at
            elif piece.startswith("<<var;"):
                least, most = map(int, piece[6:-2].split("-"))
                for k in range(most):
                    self.any |= 1 << (at + k)
                    if k >= least:
                        self.skips[at + k] = self.skips.get(at + k, 0) | 1 << (at + most)
                at += most
            elif piece.startswith("<<"):
                raise ValueError(f"unknown markup {piece}")
            else:
                for h in hash_text(piece, NOT_ALPHANUMERIC):
                    self.reads[h] = self.reads.get(h, 0) | 1 << at
                    if not opened and len(head) == at:
                        head.append(h)
                    at += 1
        if opened:
            raise ValueError("an optional region isn't closed")
        if len(head) < 2:
            raise ValueError("a template must begin with two mandatory words")
        self.head, self.accept, self.skipping = head[:2], 1 << at, sum(1 << s for s in self.skips)

    def closure(self, states: int) -> int:
        while True:
            more, due = states, states & self.skipping
            while due:
                low = due & -due
                more |= self.skips[low.bit_length() - 1]
                due ^= low
            if more == states:
                return states
            states = more

    def match(self, words: list[int]) -> int:
        """Words in the longest accepted beginning of words; 0 if none is accepted."""
        states, found = self.closure(1), 0
        for n, w in enumerate(words, 1):
            states = self.closure((states & (self.reads.get(w, 0) | self.any)) << 1)
            if states & self.accept:
                found = n
            if not states:
                break
        return found


def scan_batch(column: pa.Array, automata: dict[str, Automaton], phrases: list[tuple[list[int], str]]) -> dict[str, list]:
    lower, word = byte_class(NOT_ALPHANUMERIC)
    data, offsets = string_buffer(column)
    rows = len(offsets) - 1
    n_words, n_base = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    first, last = np.full(rows, -1, np.int64), np.full(rows, -1, np.int64)
    base = [set() for _ in range(rows)]
    found: list[list[tuple[int, int, str]]] = [[] for _ in range(rows)]
    reach = max((a.accept.bit_length() for a in automata.values()), default=0)
    for lo, hi in blocks(offsets):
        hashes, row, _, _ = words_of(data, offsets[lo : hi + 1], lower, word)
        count = np.bincount(row, minlength=hi - lo)
        n_words[lo:hi] = count
        begin = np.cumsum(count) - count

        def places(seq: list[int], hashes=hashes, row=row) -> np.ndarray:
            at = np.flatnonzero(hashes == np.uint64(seq[0]))
            at = at[at + len(seq) <= len(hashes)]
            for k, h in enumerate(seq[1:], 1):
                at = at[hashes[at + k] == np.uint64(h)]
            return at[row[at] == row[at + len(seq) - 1]]

        for seq, label in phrases:
            for p in places(seq).tolist():
                r = row[p]
                i, place = lo + r, p - begin[r]
                n_base[i] += 1
                first[i] = place if first[i] < 0 else min(first[i], place)
                last[i] = max(last[i], place)
                base[i].add(label)
        for label, automaton in automata.items():
            for p in places(automaton.head).tolist():
                r = row[p]
                n = automaton.match(hashes[p : min(p + reach, begin[r] + count[r])].tolist())
                if n:
                    found[lo + r].append((int(p - begin[r]), n, label))
    return {"n_words": n_words, "n_base": n_base, "first": first, "last": last, "base": base, "found": found}


def scan(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row for each of df: id, word and phrase counts, labels, score, and spans (start word, words, template)."""
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases

    def run(batches):
        automata = {k: Automaton(v) for k, v in templates.items()}
        known = [(hash_text(k, NOT_ALPHANUMERIC), v) for k, v in phrases.items()]
        span = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("template", pa.string())]))
        for batch in batches:
            got = scan_batch(batch.column("text"), automata, known)
            none = got["first"] < 0
            accepted = [{x[2] for x in f} for f in got["found"]]
            yield arrays_batch({
                "id": batch.column("id"), "n_words": got["n_words"], "n_base": got["n_base"],
                "first_word": pa.array(got["first"], mask=none), "last_word": pa.array(got["last"], mask=none),
                "base_labels": pa.array([",".join(sorted(x)) for x in got["base"]], pa.string()),
                "labels": pa.array([",".join(sorted(x | y)) for x, y in zip(got["base"], accepted, strict=True)], pa.string()),
                "score": pa.array([1.0 if y else 0.5 if x else 0.0 for x, y in zip(got["base"], accepted, strict=True)]),
                "spans": pa.array([[{"start": a, "words": n, "template": t} for a, n, t in sorted(f)] for f in got["found"]], span),
            })

    chosen = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<start:bigint,words:bigint,template:string>>")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans").withColumnRenamed("id", "doc_id")


QUERIES = {"op10_license_scan": op10_license_scan}
