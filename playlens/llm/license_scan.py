"""License scan by conditional compression.

A notice holds a template's words in order, with at most a tenth of them missing
or foreign, over any lines.  So one of any few words of a template, one more
than may be missing, stands in it: these telling words are looked for natively,
before any Python, and each one found gives a candidate block of the template's length
around it; blocks overlap.  Every block is compressed by zstandard with nothing and with
each of the templates as raw dictionary.  The templates that shorten it are ranked by their
size reduction and confirmed in that order, all of them, by the exact word differences;
of confirmed runs over the same words the longest, then the better ranked one stands.

The scan has no shuffle; only texts with telling words reach Python.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import map_rows, pick

#: Notices as their licenses word them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files, to deal in the Software without restriction, including without "
                "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                "copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of "
                        "the GNU General Public License as published by the Free Software Foundation, either version "
                        "3 of the License, or (at your option) any later version.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "all-rights-reserved": "All rights reserved.",
}
#: Share of a template's words that may be missing, and of foreign words between them.
DIFFERENCE = 0.1
#: Compression level for blocks.
LEVEL = 3
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def telling(template: list[str]) -> list[str]:
    """The longest words, one more than may be missing: without all of them nothing is confirmed."""
    return sorted(set(template), key=lambda w: (-len(w), w))[:int(DIFFERENCE * len(template)) + 1]


def best_run(template: list[str], block: list[str]) -> tuple[int, int, int, int] | None:
    """(start, end, missing, foreign) of the run of the block with the least
    differences that are allowed; words far off that fit a gap do not count."""
    from difflib import SequenceMatcher

    most = DIFFERENCE * len(template)
    pieces = [m for m in SequenceMatcher(None, block, template, autojunk=False).get_matching_blocks() if m.size]
    found = []
    for i in range(len(pieces)):
        same = 0
        for m in pieces[i:]:
            same += m.size
            missing, foreign = len(template) - same, m.a + m.size - pieces[i].a - same
            if foreign > most:
                break
            if missing <= most:
                found.append((missing + foreign, pieces[i].a, m.a + m.size, missing, foreign))
    return min(found)[1:] if found else None


class Scanner:
    def __init__(self, templates: dict[str, str]):
        import zstandard as z

        self.words = {k: ws for k, t in templates.items() if (ws := words(t))}
        self.telling = {k: {w: [j for j, x in enumerate(ws) if x == w] for w in telling(ws)} for k, ws in self.words.items()}
        self.plain = z.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = {}
        for k, ws in self.words.items():
            template = z.ZstdCompressionDict(" ".join(ws).encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
            template.precompute_compress(level=LEVEL)  # loaded once, not for every block
            self.given[k] = z.ZstdCompressor(level=LEVEL, write_content_size=False, dict_data=template)

    def blocks(self, ws: list[str]) -> list[tuple[int, int]]:
        """Candidate blocks: the words around every telling word, as far as its template can reach."""
        of_interest = {w for t in self.telling.values() for w in t}
        at: dict[str, list[int]] = {}
        for i, w in enumerate(ws):
            if w in of_interest:
                at.setdefault(w, []).append(i)
        found = set()
        for k, told in self.telling.items():
            n, slack = len(self.words[k]), int(DIFFERENCE * len(self.words[k]))
            for w, js in told.items():
                for p in at.get(w, ()):
                    found |= {(max(0, p - j - 2 * slack), min(len(ws), p - j + n + 2 * slack)) for j in js}
        return sorted(found)

    def ranked(self, block: list[str]) -> list[tuple[float, str]]:
        """(size reduction, template) of the templates that shorten the block, the best first."""
        data = " ".join(block).encode()
        alone = len(self.plain.compress(data))
        gains = ((1 - len(z.compress(data)) / alone, k) for k, z in self.given.items())
        return sorted((g for g in gains if g[0] > 0), key=lambda g: (-g[0], g[1]))

    def confirm(self, k: str, block: list[str]) -> tuple[int, int, int, int] | None:
        """(start, end, missing, foreign) of the run of the block that is template k but for the allowed differences."""
        template = self.words[k]
        n, slack = len(template), int(DIFFERENCE * len(template))
        if sum((Counter(template) & Counter(block)).values()) < n - slack:
            return None
        if slack:
            return best_run(template, block)
        return next(((i, i + n, 0, 0) for i in range(len(block) - n + 1) if block[i:i + n] == template), None)

    def scan(self, text: str) -> list[tuple[int, str, float, int, int]]:
        """(line, template, size reduction, missing, foreign) of every confirmed notice."""
        lowered = text.lower()
        spans = [(m.group(), m.start()) for m in _WORD.finditer(lowered)]
        ws = [w for w, _ in spans]
        found: dict[str, set] = {}
        for a, b in self.blocks(ws):
            for gain, k in self.ranked(ws[a:b]):
                got = self.confirm(k, ws[a:b])
                if got:
                    found.setdefault(k, set()).add((a + got[0], a + got[1], k, gain, *got[2:]))
        # of one template's overlapping runs the least different stays, of several templates' the longest
        own = [f for runs in found.values() for f in distinct(runs, key=lambda f: (f[4] + f[5], f[0], -f[3]))]
        kept = distinct(own, key=lambda f: (f[0] - f[1], -f[3], f[2]))
        return [(lowered.count("\n", 0, spans[a][1]), *f) for a, _, *f in sorted(kept)]


def distinct(found, key) -> list[tuple]:
    """Of runs ``(start, end, ...)`` that overlap only the first by ``key``."""
    kept: list[tuple] = []
    for f in sorted(found, key=key):
        if all(f[1] <= g[0] or g[1] <= f[0] for g in kept):
            kept.append(f)
    return kept


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per confirmed notice: ``doc_id``, ``line`` of its first word (from
    0), ``template``, ``reduction``, ``missing``, ``foreign``.

    Notices may stand anywhere in a line or over several, and a text may have
    any number of them; of templates confirmed over the same words the longest
    run, then the largest reduction goes first.  Null and empty texts have no
    notices, repeated rows are scanned each, an empty table gives no rows,
    other columns are ignored.
    """
    cue = "|".join(sorted({re.escape(w) for t in templates.values() for w in telling(words(t))}))
    slim = pick(docs, doc_id=id_col, text=text_col).where(F.lower("text").rlike(cue))
    kind = pa.list_(pa.struct([("line", pa.int32()), ("template", pa.string()), ("reduction", pa.float64()),
                               ("missing", pa.int32()), ("foreign", pa.int32())]))

    def run(cols):
        scanner = Scanner(templates)  # a few templates: cheap beside a batch
        names = [f.name for f in kind.value_type]
        return [pa.array([[dict(zip(names, f)) for f in scanner.scan(t.as_py())] for t in cols[0]], kind)]

    found = map_rows(slim, ["text"], run, "notices array<struct<line:int,template:string,reduction:double,missing:int,foreign:int>>")
    return found.select("doc_id", F.explode("notices").alias("notice")).select("doc_id", "notice.*")
