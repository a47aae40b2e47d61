"""License notices in texts, by MinHash bands over overlapping windows.

Templates are short notices, as sets of two-word shingles. A text is read in windows as long as a
template is (one of a few lengths, stepping by a third), and each window's MinHash bands look
templates up. A band is one row, so that a window whose similarity to a template is s meets it with probability
1 - (1 - s)**BANDS. Some window holds a whole notice and at most 9/4 of its length, so s is 4/9 at
least there, and the notice is missed with probability 8e-7. A retrieved template is then verified exactly on
the window: the share of its shingles that are in it, and all shingles that set it apart from similar notices of other
licenses (version, ShareAlike, Lesser). Of readings that overlap the one with most shingles counts. Texts with fewer template shingles than any
notice needs hold none and are not banded.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcart.llm.words import Words, as_bytes, map_slices, mix, shingle_hashes



def _creative_commons() -> dict[str, tuple[str, ...]]:
    """The six licenses in their versions, in full and by their short names."""
    words = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
    ports = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}
    out = {}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        full = "-".join(words[part] for part in kind.split("-"))
        for version, port in ports.items():
            out[f"CC-{kind}-{version}"] = (
                f"Licensed under CC {kind} {version}.",
                f"This work is licensed under a Creative Commons {full} {version} {port} License.",
            )
    return out


def _gnu(kind: str, version: str) -> tuple[str, ...]:
    """By its name and version; and the notice of a program, which names its version behind the license."""
    return (
        f"This work is licensed under the GNU {kind}General Public License, version {version}.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        f"GNU {kind}General Public License as published by the Free Software Foundation; either version "
        f"{version} of the License",
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        f"GNU {kind}General Public License version {version} as published by the Free Software Foundation",
    )


# Notices of common licenses, by their SPDX names.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at",
    ),
    "Apache-1.1": ("Licensed under the Apache License, Version 1.1.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License",
        *_gnu("", "3")[1:],
    ),
    "GPL-2.0": _gnu("", "2"),
    "GPL-1.0": _gnu("", "1"),
    "LGPL-3.0": _gnu("Lesser ", "3"),
    "LGPL-2.1": _gnu("Lesser ", "2.1"),
    "LGPL-2.0": _gnu("Library ", "2"),
    "AGPL-3.0": _gnu("Affero ", "3"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.",),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC0-1.0": (
        "Licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
    ),
    **_creative_commons(),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    **{
        f"MPL-{version}": (
            f"This Source Code Form is subject to the terms of the Mozilla Public License, v. {version}.",
            f"The contents of this file are subject to the Mozilla Public License Version {version} (the License); "
            "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        )
        for version in ("1.1", "1.0")
    },
}

SHINGLE = 2
BANDS = 24
CONTAINMENT = 0.8
# Notices of different names that share so much of the one, all but so many shingles: those the text must have.
SIBLINGS, MARKS = 0.5, 3
_BREAKS = np.ones(256, bool)
_BREAKS[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = False
_BREAKS[128:] = False


@dataclass
class Shelf:
    """Templates with their shingles and bands, by window length."""

    names: list[str]
    notices: list[np.ndarray]

    def __post_init__(self) -> None:
        rng = np.random.default_rng(77)
        self.salts = rng.integers(0, 2**64, BANDS, dtype=np.uint64)
        self.sets = [np.unique(s) for s in self.notices]
        # what sets a template apart from each notice of another name that is nearly the same
        self.marks = [np.unique(np.concatenate([s[:0], *self._marks(k)])) for k, s in enumerate(self.sets)]
        self.by_length: dict[int, list[int]] = {}
        for k, shingles in enumerate(self.notices):
            # windows of half a notice more, in steps of a third: one of them holds it whole
            self.by_length.setdefault(self.window(len(shingles)), []).append(k)
        self.bands = {
            length: [self._band(own, salt) for salt in self.salts] for length, own in self.by_length.items()
        }

    def _marks(self, k: int) -> list[np.ndarray]:
        own = self.sets[k]
        apart = [np.setdiff1d(own, s) for s, n in zip(self.sets, self.names, strict=True) if n != self.names[k]]
        return [m for m in apart if len(m) <= min(len(own) * (1 - SIBLINGS), MARKS)]

    @staticmethod
    def window(shingles: int) -> int:
        size = 4
        while size < shingles:
            size = size * 3 // 2
        return size * 3 // 2

    def _band(self, own: list[int], salt: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Sorted minima of the templates under one hash, and which template each is of."""
        least = np.array([mix(self.sets[k] ^ salt).min() for k in own], np.uint64)
        order = np.argsort(least, kind="stable")
        return least[order], np.array(own)[order]


def shelf(templates: dict[str, tuple[str, ...]] = TEMPLATES) -> Shelf:
    names, notices = [], []
    for name, texts in templates.items():
        for text in texts:
            hashes = Words([text.lower().encode()], breaks=_BREAKS).hashes()
            if len(hashes):
                names.append(name)
                notices.append(shingle_hashes(hashes, SHINGLE))
    return Shelf(names, notices)


def _least(values: np.ndarray, size: int, step: int) -> np.ndarray:
    """Minimum of each window of ``size`` values, at every ``step``-th place; the last may be shorter."""
    blocks = -(-len(values) // step)
    padded = np.full((blocks + -(-size // step)) * step, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    of_block = padded.reshape(-1, step).min(axis=1)
    whole = size // step
    out = of_block[:blocks].copy()
    for k in range(1, whole):
        out = np.minimum(out, of_block[k : blocks + k])
    return out


def notices(texts: list[bytes], known: Shelf, containment: float = CONTAINMENT) -> list[list[tuple]]:
    """Per text its notices: (name, first word, end, containment), in order, not overlapping."""
    lowered = [t.decode("utf-8", "replace").lower().encode() for t in texts]
    words = Words(lowered, lower=False, breaks=_BREAKS)
    found: list[list[tuple]] = [[] for _ in texts]
    parts, origin, first = [], [], [0]
    every, hashes = np.unique(np.concatenate(known.sets)), words.hashes()
    fewest = min(np.ceil(containment * len(s)) for s in known.sets)
    for i in range(len(texts)):
        own = hashes[words.first[i] : words.first[i + 1]]
        own = shingle_hashes(own, SHINGLE)
        if np.isin(own, every).sum() >= fewest:
            parts.append(own)
            origin.append(i)
            first.append(first[-1] + len(own))
    if not parts:
        return found
    shingles = np.concatenate(parts)
    text_of = np.repeat(np.arange(len(parts)), np.diff(first))
    hit: set[tuple[int, int, int]] = set()
    for j, salt in enumerate(known.salts):
        mixed = mix(shingles ^ salt)
        for length, bands in known.bands.items():
            least, owners = bands[j]
            step = max(length // 3, 1)
            size = -(-length // step) * step
            minima = _least(mixed, size, step)
            at = np.flatnonzero(np.isin(minima, least))
            lo = np.searchsorted(least, minima[at], "left")
            hi = np.searchsorted(least, minima[at], "right")
            for place, a, b in zip((at * step).tolist(), lo.tolist(), hi.tolist(), strict=True):
                hit.update((place, size, int(owner)) for owner in owners[a:b])
    checked: dict[int, list[tuple[int, float, int, int, str, int, int]]] = {}
    for place, size, k in sorted(hit):
        # a window may begin before a text and end behind it: the words of each text in it by themselves
        for text in np.unique(text_of[place : place + size]).tolist():
            start = max(place, first[text])
            own = shingles[start : min(place + size, first[text + 1])]
            inside = np.isin(own, known.sets[k])
            matched = len(np.unique(own[inside]))
            share = matched / len(known.sets[k])
            if share >= containment and np.isin(known.marks[k], own).all():
                spots = np.flatnonzero(inside)
                base = start - first[text]
                core = _core(own, spots)
                checked.setdefault(origin[text], []).append(
                    (matched, share, base + int(spots[0]), base + int(spots[-1]) + SHINGLE, known.names[k],
                     base + core[0], base + core[1] + SHINGLE)
                )
    for text, spans in checked.items():
        taken: list[tuple[str, int, int, int, int]] = []
        # the notice that explains most of the text comes first
        for _, share, a, b, name, c, d in sorted(set(spans), key=lambda s: (-s[0], -s[1], s[2], s[3], s[4])):
            if all((b <= x[1] or a >= x[2]) if x[0] == name else (d <= x[3] or c >= x[4]) for x in taken):
                taken.append((name, a, b, c, d))
                found[text].append((name, a, b, share))
    return [sorted(f, key=lambda x: (x[1], x[0])) for f in found]


def _core(own: np.ndarray, spots: np.ndarray) -> tuple[int, int]:
    """First and last place of the shortest stretch that has every matched shingle."""
    values = own[spots].tolist()
    places, need = spots.tolist(), len(set(values))
    counts: dict[int, int] = {}
    best, left = (places[0], places[-1]), 0
    for right, value in enumerate(values):
        counts[value] = counts.get(value, 0) + 1
        while len(counts) == need:
            if places[right] - places[left] < best[1] - best[0]:
                best = (places[left], places[right])
            counts[values[left]] -= 1
            if not counts[values[left]]:
                del counts[values[left]]
            left += 1
    return best


def licenses(docs: DataFrame, known: Shelf | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """A row per document and notice: doc_id, license, first_word, end_word, containment.

    Words are counted in the document from 0, end exclusive. Notices do not overlap; of several
    readings the one with most shingles, then the most contained, then the first counts. A null or empty text has no rows.
    """
    own = known or shelf()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id").to_pylist()
        rows = [
            (ids[i], *notice)
            for i, found in enumerate(notices(as_bytes(batch.column("text")), own, containment))
            for notice in found
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["doc_id", "license", "first_word", "end_word", "containment"],
        )

    return map_slices(
        docs.select(F.col("doc_id").cast("long"), "text"),
        run,
        "doc_id long, license string, first_word long, end_word long, containment double",
    )
