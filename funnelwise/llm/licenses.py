"""Licence scans: lines, paragraphs, whole texts and parts of template length against templates, by Dice over word bigrams."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Chunk, chunks, group_by_row

#: Normalised words are runs of ASCII letters, digits and non-ASCII bytes, in lower case.
_SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

# Usual statements and notices of common licences, those that the SQL compares with.
TEMPLATES = {
    "mit_statement": "Released under the MIT License.",
    "apache_2_statement": "Licensed under the Apache License, Version 2.0.",
    "gpl_3_statement": "This work is licensed under the GNU General Public License, version 3.",
    "cc_by_nc_4_statement": "Licensed under CC BY-NC 4.0.",
    "cc_by_4_statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd_3_statement": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mit_notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so."
    ),
    "apache_2_notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "gpl_3_notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
}


_GNU = {
    "gpl": ("General", ("1", "2", "3")), "lgpl": ("Lesser General", ("2.1", "3")), "lgpl_library": ("Library General", ("2",)), "agpl": ("Affero General", ("3",)),
}
_CC = {"by": "Attribution", "by_sa": "Attribution-ShareAlike", "by_nd": "Attribution-NoDerivatives", "by_nc": "Attribution-NonCommercial", "by_nc_sa": "Attribution-NonCommercial-ShareAlike", "by_nc_nd": "Attribution-NonCommercial-NoDerivatives"}
_OTHER = {
    "mit": "MIT License", "isc": "ISC License", "bsd_2": "BSD 2-Clause License", "bsd_3": "BSD 3-Clause License", "apache": "Apache License", "apache_1_0": "Apache License, Version 1.0",
    "apache_1_1": "Apache License, Version 1.1", "apache_2": "Apache License, Version 2.0", "mpl": "Mozilla Public License", "mpl_1_1": "Mozilla Public License, Version 1.1", "mpl_2": "Mozilla Public License, Version 2.0",
    "bsl_1": "Boost Software License, Version 1.0", "epl_1": "Eclipse Public License, Version 1.0", "epl_2": "Eclipse Public License, Version 2.0", "ofl_1_1": "SIL Open Font License, Version 1.1", "artistic_2": "Artistic License 2.0",
}
_FREE = "{} is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_ONLY = "{} is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License version {} as published by the Free Software Foundation."
_NOTICES = {
    "mpl_2_notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mpl_1_1_notice": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.mozilla.org/MPL/"
    ),
    "bsl_1_notice": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    "bsd_notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc0_1_notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}


def statements() -> dict[str, str]:
    """Short statements and notices of the common licences, each with those of its other versions and variants."""
    found = dict(_NOTICES)
    for name, title in _OTHER.items():
        found |= {f"{name}_statement_licensed": f"Licensed under the {title}.", f"{name}_statement_released": f"Released under the {title}."}
    for name, (kind, versions) in _GNU.items():
        for ways, start in (("licensed", "Licensed"), ("released", "Released"), ("work", "This work is licensed")):
            found[f"{name}_statement_{ways}"] = f"{start} under the GNU {kind} Public License."
            found |= {f"{name}_{v.replace('.', '_')}_statement_{ways}": f"{start} under the GNU {kind} Public License, version {v}." for v in versions}
        for v in versions:
            for of in ("program", "library"):
                found[f"{name}_{v.replace('.', '_')}_notice_{of}"] = _FREE.format(f"This {of}", kind, v)
                found[f"{name}_{v.replace('.', '_')}_only_notice_{of}"] = _ONLY.format(f"This {of}", kind, v)
    for name, title in _CC.items():
        for v, port in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
            key = f"cc_{name}_{v.removesuffix('.0').replace('.', '_')}_statement"
            found[f"{key}_short"] = f"Licensed under CC {name.upper().replace('_', '-')} {v}."
            found[f"{key}_work"] = f"This work is licensed under a Creative Commons {title} {v} {port} License."
    return {n: t for n, t in found.items() if t not in TEMPLATES.values()}


def whole_texts() -> dict[str, str]:
    """The licence texts of `license_texts`, which is read with the package."""
    return {f"{f.name[:-4]}_text": f.read_text("utf-8") for f in resources.files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")}


def all_templates() -> dict[str, str]:
    """TEMPLATES, further statements and notices, and whole licence texts."""
    return TEMPLATES | statements() | whole_texts()


@dataclass
class TemplateIndex:
    """Distinct bigram hashes of each template, with its length in bigrams, and of all together with the templates that hold each."""

    names: list[str]
    bigrams: list[np.ndarray]
    lengths: list[int]
    least: float

    @classmethod
    def of(cls, templates: dict[str, str], least: float) -> TemplateIndex:
        found, lengths = {}, []
        for name, text in sorted(templates.items()):
            (chunk,) = chunks(pa.array([text], pa.large_string()), separators=_SEPARATORS)
            grams = chunk.windows(chunk.word_hashes(lower=True), 2)[1]
            if len(grams):
                found[name] = np.unique(grams)
                lengths.append(len(grams))
        return cls(list(found), list(found.values()), lengths, least)

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(b) for b in self.bigrams], np.int64)

    @cached_property
    def known(self) -> np.ndarray:
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *self.bigrams]))

    @cached_property
    def owners(self) -> tuple[np.ndarray, np.ndarray]:
        """Templates by known bigram: where those of each begin, and the templates."""
        gram = np.concatenate([np.zeros(0, np.int64), *(np.searchsorted(self.known, b) for b in self.bigrams)])
        template = np.repeat(np.arange(len(self.names), dtype=np.int16), self.sizes)
        order = np.argsort(gram, kind="stable")
        return np.searchsorted(gram[order], np.arange(len(self.known) + 1)), template[order]

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index in `grams`, and in `known`, of those that some template holds."""
        if not len(self.known):
            return np.zeros((2, 0), np.int64)
        place = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        at = np.flatnonzero(self.known[place] == grams)
        return at, place[at]

    def held(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index in `place`, and template, of every template that holds one of the known bigrams."""
        first, templates = self.owners
        n = first[place + 1] - first[place]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(place)), n), templates[np.repeat(first[place], n) + within]

    def best(self, unit: np.ndarray) -> tuple[float, str, float] | None:
        """Dice, name and excess of the most similar template to a unit's distinct bigrams, the first by name on ties."""
        shared = np.bincount(self.held(self.find(unit)[1])[1], minlength=len(self.names))
        dice = 2 * shared / (self.sizes + len(unit))
        k = int(dice.argmax())
        return (float(dice[k]), self.names[k], float((dice[k] - self.least) * (self.sizes[k] + len(unit)))) if dice[k] >= self.least else None


def units(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and row of every line, paragraph and whole text, each range once.

    Lines end at \\n, \\r\\n or \\r. Paragraphs are parted by two adjacent \\n, and those of another reading by any line without a word.
    """
    feed = np.flatnonzero(chunk.data == 10)
    paragraph = feed[1:][np.diff(feed) == 1]
    back = np.flatnonzero(chunk.data == 13)
    alone = back[chunk.data[np.minimum(back + 1, len(chunk.data) - 1)] != 10]
    line = np.union1d(feed, alone)
    edges = np.union1d(chunk.row_at, line + 1)
    words = np.searchsorted(chunk.spans[0], edges)
    blank = words[:-1][words[:-1] == words[1:]]
    out = [np.stack([words[:-1], words[1:]])]
    for borders in (np.searchsorted(chunk.spans[0], paragraph + 1), blank, np.zeros(0, np.int64)):
        borders = np.union1d(chunk.word_at, borders)
        out.append(np.stack([borders[:-1], borders[1:]]))
    start, end = np.unique(np.concatenate(out, axis=1), axis=1)
    long = end - start >= 2
    return start[long], end[long], chunk.word_row[start[long]]


def _ahead(at: np.ndarray, kind: np.ndarray, width: int) -> np.ndarray:
    """For each of some ascending positions, how many kinds lie at it or less than `width` after it."""
    order = np.argsort(kind, kind="stable")
    same = kind[order][1:] == kind[order][:-1]
    before = np.full(len(at), -1)
    before[order[1:][same]] = order[:-1][same]
    first = np.maximum(before + 1, np.searchsorted(at, at - width, "right"))
    steps = np.bincount(first, minlength=len(at) + 1)
    steps[1:] -= 1
    return np.cumsum(steps)[:-1]


def _reach(new: np.ndarray, held: np.ndarray, size: int) -> tuple[int, float]:
    """The prefix of some bigrams most similar to a template of `size` distinct ones: its length (the least on ties) and Dice.

    `new` marks the first of equal bigrams, `held` those of the template.
    """
    dice = 2 * np.cumsum(new & held) / (size + np.cumsum(new))
    k = int(dice.argmax())
    return k + 1, float(dice[k])


def _hopeless(dice: float, least: float, size: int) -> float:
    """How far from a start, whose best part has a Dice below the least, no other start has a better part of the least.

    `size` is the least sum of distinct bigrams of both sides. A part that starts d words away has at most d more shared bigrams and d
    fewer of its own: 2 (shared + d) / (size - d) stays below the least up to here.
    """
    return (least - dice) * size / (2 + least) - 1e-9


def parts(index: TemplateIndex, grams: np.ndarray, row: np.ndarray, edge: np.ndarray, at: np.ndarray, place: np.ndarray) -> list[tuple[float, int, int, float, str]]:
    """(excess, first word, end word, dice, template) of the parts of texts that are at least `least` similar to a template.

    `grams` is the bigram at each word and `edge` the words where rows begin; `at` and `place` are the words at known bigrams and which.
    A part of Dice t and n distinct bigrams shares t / (2 - t) of either side or more: where fewer of a template's bigrams lie
    within the longest such part there is none. From each other bigram a part grows forward and from its end
    back to where it is most similar; a start that fails rules out those near it. Parts of one template do not overlap. The excess is that of shared bigrams over the least.
    """
    which, template = index.held(place)
    order = np.argsort(template, kind="stable")
    cuts = np.searchsorted(template[order], np.arange(len(index.names) + 1))
    least, out = index.least, []
    equal = np.argsort(grams, kind="stable")
    same = grams[equal][1:] == grams[equal][:-1]
    before, following = np.full(len(grams), -1), np.full(len(grams), len(grams))
    before[equal[1:][same]], following[equal[:-1][same]] = equal[:-1][same], equal[1:][same]
    held = np.zeros(len(grams), bool)
    for t, own in enumerate(index.bigrams):
        fewest = int(np.ceil(least * len(own) / (2 - least) - 1e-9))
        mine = which[order[cuts[t] : cuts[t + 1]]]
        if len(mine) < max(fewest, 1):
            continue
        width = int(np.ceil((2 / least - 1) * index.lengths[t]))
        p, of = at[mine], row[at[mine]]
        n = _ahead(p + of * (width + 1), place[mine], width)  # rows further apart than any part is long
        starts, ends = [], []
        start = np.flatnonzero(n >= max(fewest, 1))
        place_of, open_ = p[start], np.ones(len(start), bool)
        held[p] = True
        for j in np.argsort(-n[start], kind="stable"):
            if not open_[j]:
                continue
            k = start[j]
            low, high = edge[of[k]], edge[of[k] + 1] - 1
            after = bisect_right(starts, p[k])
            if after and p[k] < ends[after - 1]:
                continue
            low = max(low, ends[after - 1] if after else 0)
            high = min(high, starts[after] if after < len(starts) else high)
            first, last = p[k], min(high, p[k] + width)
            ahead, dice = _reach(before[first:last] < first, held[first:last], len(own))
            if dice < least:
                far = int(_hopeless(dice, least, len(own) + max(fewest, 1)))
                a, b = np.searchsorted(place_of, np.array([max(edge[of[k]], p[k] - far), min(edge[of[k] + 1], p[k] + far + 1)], place_of.dtype))
                open_[a:b] = False
                continue
            end = p[k] + ahead
            first = max(low, end - width)
            back, dice = _reach((following[first:end] >= end)[::-1], held[first:end][::-1], len(own))
            if dice >= least:
                s = int(end - back)
                starts.insert(after, s)
                ends.insert(after, int(end))
                out.append(((dice - least) * (len(own) + len(np.unique(grams[s:end]))), s, int(end) + 1, dice, index.names[t]))
        held[p] = False
    return out


def apart(found: list[tuple[float, int, int, float, str]], matched: list[tuple[float, int, int]], words: int) -> Iterator[tuple[int, int, float, str]]:
    """Parts, but those inside a matched unit (excess, first word, end word) and those whose middle word a unit or part of no less excess holds."""
    most, until = np.full(words, -1.0), np.zeros(words, np.int64)
    for excess, s, e in matched:
        most[s:e] = np.maximum(most[s:e], excess)
        until[s] = max(until[s], e)
    until = np.maximum.accumulate(until)
    for excess, s, e, dice, name in sorted(found, key=lambda f: (-f[0], f[1] - f[2], f[4], f[1])):
        if until[s] < e and most[(s + e - 1) // 2] < excess:
            most[s:e] = np.maximum(most[s:e], excess)
            yield s, e, dice, name


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.75, text: str = "text", ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`ids`, start, end (words of the normalised text), license, dice: each unit or part at least `least` similar to a template.

    Units are lines, paragraphs and whole texts; a unit has its best template only. Parts are the runs of words, anywhere in a text, that
    are most similar to a template; those inside a matched unit, or around whose middle something matches better, are left out. Null and empty texts, and units of fewer than two words, match nothing; repeated rows each
    have their matches; other columns are ignored. One map pass. No `templates`: all of the module.
    """
    index = TemplateIndex.of(all_templates() if templates is None else templates, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for chunk in chunks(batch.column(len(ids)), separators=_SEPARATORS):
                at, grams = chunk.windows(chunk.word_hashes(lower=True), 2)
                if not len(at):
                    continue
                hit, place = index.find(grams)
                of_template, first_in_row = np.zeros((2, len(chunk.spans[0]) + 1), np.int64)
                of_template[at[hit] + 1] = 1
                order = group_by_row(grams, chunk.word_row[at])
                new = np.ones(len(at), bool)
                new[order[1:]] = (grams[order[1:]] != grams[order[:-1]]) | (chunk.word_row[at[order[1:]]] != chunk.word_row[at[order[:-1]]])
                first_in_row[at + 1] = new
                before, distinct = np.cumsum(of_template), np.cumsum(first_in_row)
                start, end, row = units(chunk)
                shared = before[end - 1] - before[start]
                share = least / (2 - least)
                fewest = np.maximum(distinct[end - 1] - distinct[start], min(index.sizes, default=0)) * share - 1e-9
                by_word = np.zeros(len(chunk.spans[0]), np.uint64)
                by_word[at] = grams
                matched, better = [], []
                for k in np.flatnonzero((shared > 0) & (shared >= fewest)):
                    best = index.best(np.unique(by_word[start[k] : end[k] - 1]))
                    if best:
                        matched.append((start[k], end[k], best[1], best[0]))
                        better.append((best[2], start[k], end[k]))
                inner = parts(index, by_word, chunk.word_row, chunk.word_at, at[hit], place)
                matched += [(s, e, name, dice) for s, e, dice, name in apart(inner, better, len(by_word))]
                for s, e, name, dice in matched:
                    own = chunk.word_row[s]
                    found.append((chunk.first_row + own, s - chunk.word_at[own], e - chunk.word_at[own], name, dice))
            row, start, end, name, dice = zip(*found) if found else ((),) * 5
            picked = [c.take(pa.array(row, pa.int64())) for c in batch.columns[: len(ids)]]
            values = [pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(name, pa.string()), pa.array(dice, pa.float64())]
            yield pa.RecordBatch.from_arrays(picked + values, names=[*ids, "start", "end", "license", "dice"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ids)
    return docs.select(*ids, F.col(text)).mapInArrow(run, f"{kinds}, start long, end long, license string, dice double")
