"""Licence notices by Dice coefficient of word bigrams against templates (op 5).

Windows of words slide over the whole text, across lines, so a notice counts inside a longer line, wrapped over
several, or as the full text of a licence. With a and b bigrams the coefficient is at most 2 * min(a, b) / (a + b),
which bounds a template's windows, and the bigrams that they must hit: texts without so many hits close enough
together are passed over, and no other window can reach the threshold. Windows start and end on a hit, as
trimming anything else only raises the coefficient.

Of windows that overlap, the one with most hits less misses is the notice (a full text before a sentence in it,
ties by coefficient); the others are sought again in the words that are left. Templates are a parameter: pairs of a name
and a text; by default, one-sentence notices and the full texts in ``licence_texts``.

Null and empty texts have no notices; ties go to the template listed first, then to the earlier place; repeated rows are scanned each
for itself; an empty table gives no rows; columns other than the id and the text aren't read.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from importlib import resources
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST = 0.8
#: Windows of templates up to so many bigrams are computed for all starts at once.
SHORT = 64

# Public notices as their licences word them.
NOTICES = (
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    # neighbours of these, which would pass for them but for their own templates
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    *((f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}.") for v in ("4.0", "3.0", "2.5", "2.0") for kind in ("BY-NC-SA", "BY-NC-ND", "BY-NC", "BY-SA", "BY-ND", "BY") if (kind, v) not in (("BY-NC", "4.0"), ("BY", "4.0"))),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def bigrams(text: str) -> Counter:
    words = WORD.findall(text.lower())
    return Counter(zip(words, words[1:], strict=False))


def full_texts() -> tuple[tuple[str, str], ...]:
    files = sorted((f for f in resources.files("sparkloom.llm").joinpath("licence_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return tuple((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in files)


TEMPLATES = NOTICES + full_texts()


class Matcher:
    """Templates as bigram counts, with the window sizes and hits that can reach the threshold."""

    def __init__(self, templates=TEMPLATES, least: float = LEAST):
        self.least = least
        found = [(name, grams) for name, text in templates if (grams := bigrams(text))]
        self.names = [name for name, _ in found]
        self.kinds = {pair: i for i, pair in enumerate(dict.fromkeys(p for _, grams in found for p in grams))}
        self.counts = np.zeros((len(found), len(self.kinds)), np.int32)
        for row, (_, grams) in zip(self.counts, found, strict=True):
            row[[self.kinds[p] for p in grams]] = list(grams.values())
        self.held = self.counts > 0
        self.sizes = self.counts.sum(1)
        self.need = [math.ceil(n * least / (2 - least) - 1e-9) for n in self.sizes]
        self.most = [math.floor(n * (2 - least) / least + 1e-9) for n in self.sizes]
        self.fewest = min(self.need, default=math.inf)

    def prior(self, k: int, kind: np.ndarray) -> np.ndarray:
        """For each hit the hit of its kind as many places before as the template holds it, else -1: it counts in a window that starts behind that."""
        order = np.argsort(kind, kind="stable")
        ranked = kind[order]
        held = self.counts[k][ranked]
        at = np.arange(len(kind))
        full = at - np.searchsorted(ranked, ranked) >= held
        out = np.full(len(kind), -1, np.int64)
        out[order[full]] = order[at[full] - held[full]]
        return out

    def window(self, k: int, place: np.ndarray, prior: np.ndarray, at: int, end: int) -> tuple | None:
        """Best window of template ``k`` that starts at hit ``at`` and ends before bigram ``end``."""
        stop = np.searchsorted(place, min(end, place[at] + self.most[k]))
        if stop <= at:
            return None
        hits = np.cumsum(prior[at:stop] < at, dtype=np.int32)
        size = place[at:stop] - (place[at] - 1)
        worth = 2 * hits - size
        total = self.sizes[k]
        # of equal worth the longest window has the best coefficient
        best = len(worth) - 1 - int(worth[::-1].argmax())
        if 2 * hits[best] / (size[best] + total) < self.least:
            if worth[best] < self.least * total - (1 - self.least) * self.most[k] - 1e-6:
                return None
            able = 2 * hits / (size + total) >= self.least
            if not able.any():
                return None
            worth = np.where(able, worth, worth.min() - 1)
            best = len(worth) - 1 - int(worth[::-1].argmax())
        return (-int(worth[best]), -float(2 * hits[best] / (size[best] + total)), k, int(place[at]), int(place[at + best]) + 1, at)

    def windows(self, k: int, place: np.ndarray, prior: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
        """The best window of each start of a short template, some thousand starts at a time."""
        for low in range(0, len(starts), 4096):
            at = starts[low : low + 4096, None]
            stop = np.searchsorted(place, place[at] + self.most[k])
            reach = at + np.arange(int((stop - at).max()))
            inside = reach < stop
            reach = np.minimum(reach, len(place) - 1)
            hits = np.cumsum((prior[reach] < at) & inside, axis=1)
            size = place[reach] - place[at] + 1
            dice = 2 * hits / (size + self.sizes[k])
            worth = np.where(inside & (dice >= self.least), 2 * hits - size, -math.inf)
            most = worth.max(1)
            best = np.where(worth == most[:, None], dice, -1).argmax(1)
            for i in np.flatnonzero(most > -math.inf):
                yield (-int(most[i]), -float(dice[i, best[i]]), k, int(place[at[i, 0]]), int(place[at[i, 0] + best[i]]) + 1, int(at[i, 0]))

    def bound(self, k: int, place: np.ndarray, prior: np.ndarray, low: int, high: int, end: int) -> tuple | None:
        """A block of starts ``low`` to ``high`` (exclusive) with a worth that none of its windows before bigram ``end`` exceeds; None if none can count."""
        last, total = high - 1, self.sizes[k]
        stop = np.searchsorted(place, min(end, place[last] + self.most[k]))
        if stop <= low:
            return None
        hits = np.minimum(np.cumsum(prior[low:stop] < last, dtype=np.int32), total)
        size = np.maximum(place[low:stop] - (place[last] - 1), 1)
        able = 2 * hits >= self.least * (size + total) - 1e-9
        worth = (2 * hits - size)[able]
        if not len(worth):
            return None
        most = min(int(worth.max()), int(total))  # a window's worth is at most its hits
        return (-most, -float((most + self.most[k]) / (self.most[k] + total)) if most < total else -1.0, k, int(place[low]), high, -1 - low)

    def notices(self, text: str) -> list[tuple[float, str]]:
        """Coefficient and name of each notice; a notice's words are in no other.

        Starts of a long template wait in blocks under a bound of their worth. Only a block at the head of the queue is split,
        so that most starts lie in a notice that is taken before they are looked at.
        """
        words = WORD.findall(text.lower())
        kinds = np.fromiter(map(self.kinds.get, zip(words, words[1:], strict=False), repeat(-1)), np.int64, max(0, len(words) - 1))
        places = np.flatnonzero(kinds >= 0)
        if len(places) < self.fewest:
            return []
        kinds = kinds[places]
        hits, heap = {}, []
        for k in np.flatnonzero(self.held[:, kinds].sum(1) >= self.need):
            k = int(k)
            own = self.held[k][kinds]
            place, need = places[own], self.need[k]
            starts = np.flatnonzero(place[need - 1 :] - place[: len(place) - need + 1] < self.most[k])
            if not len(starts):
                continue
            prior = self.prior(k, kinds[own])
            hits[k] = place, prior
            if self.sizes[k] <= SHORT:
                heap += self.windows(k, place, prior, starts)
                continue
            # blocks of starts beside each other
            size = max(1, int(self.sizes[k]) // 8)
            for low in np.unique(starts // size) * size:
                block = self.bound(k, place, prior, int(low), min(int(low) + size, len(place)), len(words))
                heap += [block] if block else []
        heapq.heapify(heap)
        taken: list[tuple[int, int]] = []  # stretches of words, those beside each other as one
        found = []

        def free_from(word: int) -> tuple[int, int]:
            """The first word from ``word`` that isn't taken, and the first one behind it that is."""
            i = bisect_right(taken, (word, math.inf))
            if i and taken[i - 1][1] >= word:
                word = taken[i - 1][1] + 1
            return word, taken[i][0] if i < len(taken) else len(words) + 1

        while heap:
            _, dice, k, low, high, at = heapq.heappop(heap)
            place, prior = hits[k]
            if at < 0:  # starts -1 - at to high
                low = max(-1 - at, int(np.searchsorted(place, free_from(low)[0])))
                step = max(1, -(-(high - low) // 8))
                for start in range(low, high, step):
                    stop = min(start + step, high)
                    word, until = free_from(int(place[start]))
                    if stop - start == 1:
                        part = self.window(k, place, prior, start, until - 1) if word == place[start] else None
                    else:
                        part = self.bound(k, place, prior, start, stop, until - 1 if place[stop - 1] < until and word == place[start] else len(words))
                    if part:
                        heapq.heappush(heap, part)
                continue
            word, until = free_from(low)  # words low to high
            if word > low:
                continue
            if until <= high:
                again = self.window(k, place, prior, at, until - 1)
                if again:
                    heapq.heappush(heap, again)
                continue
            found.append((-dice, self.names[k]))
            i = bisect_right(taken, (low, math.inf))
            if i < len(taken) and taken[i][0] == high + 1:
                high = taken.pop(i)[1]
            if i and taken[i - 1][1] == low - 1:
                low = taken.pop(i - 1)[0]
                i -= 1
            taken.insert(i, (low, high))
        return found


def scan(docs: DataFrame, text: str = "text", id_column: str = "doc_id", templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``(id, n_notices, licences, best)``: notices found, their distinct names in order, the best coefficient."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, least)
        for batch in batches:
            counts, names, best = [], [], []
            for value in batch.column(1):
                found = matcher.notices(value.as_py() or "")
                counts.append(len(found))
                names.append(",".join(sorted({name for _, name in found})))
                best.append(max((d for d, _ in found), default=0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(best, pa.float64())], names=[id_column, "n_notices", "licences", "best"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(run, f"{id_column} {kind}, n_notices bigint, licences string, best double")
