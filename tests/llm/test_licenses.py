"""Notices at every place of a text, and the exact containment."""

from __future__ import annotations

import random
import re

import pytest
from llm.conftest import prose

from starcart.llm.licenses import TEMPLATES, licenses, notices, shelf

KNOWN = shelf()


def plain(text):
    return re.findall(r"[a-z0-9]+", text.lower())


@pytest.mark.parametrize("name", TEMPLATES)
def test_found_wherever_it_stands(name):
    rng = random.Random(name)
    texts, places = [], []
    for notice in TEMPLATES[name]:
        for before in [*range(0, 45, 4), 1000, 5001]:
            words = prose(rng, before + 60)
            texts.append(" ".join([*words[:before], notice.upper(), *words[before:]]).encode())
            places.append((before, before + len(plain(notice))))
        texts.append(notice.encode())
        places.append((0, len(plain(notice))))
    for found, (start, end) in zip(notices(texts, KNOWN), places, strict=True):
        assert [(n, a, b, s) for n, a, b, s in found if n == name] == [(name, start, end, 1.0)]


def test_containment_decides():
    notice = TEMPLATES["BSD-3-Clause"][0].split()
    few, many = list(notice), list(notice)
    few[10] = "changed"
    many[::3] = ["changed"] * len(many[::3])
    one, none = notices([" ".join(few).encode(), " ".join(many).encode()], KNOWN)
    assert [n for n, *_ in one] == ["BSD-3-Clause"]
    assert 0.8 <= one[0][3] < 1
    assert none == []


@pytest.mark.parametrize("name", TEMPLATES)
def test_no_notice_is_taken_for_another_license(name):
    rng = random.Random(name)
    for notice in TEMPLATES[name]:
        for before in (0, 7, 40):
            words = prose(rng, before + 40)
            text = " ".join([*words[:before], notice, *words[before:]])
            (found,) = notices([text.encode()], KNOWN)
            assert [n for n, *_ in found] == [name], notice


def test_licenses_off_the_shelf_are_no_others():
    texts = [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 9.0 International License.",
        "This work is licensed under the GNU General Public License, version 9.",
        "This work is licensed under the GNU Other General Public License, version 3.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 9.0.",
        "Licensed under CC BY-XX-SA 4.0.",
    ]
    assert notices([t.encode() for t in texts], KNOWN) == [[]] * len(texts)


def test_other_wordings_keep_their_version():
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; {} of the License."
    texts = {
        "This work is licensed under a Creative Commons Attribution 4.0 License.": "CC-BY-4.0",
        gpl.format("General Public License", "version 2"): "GPL-2.0",
        gpl.format("General Public License", "version 3"): "GPL-3.0",
        gpl.format("Lesser General Public License", "version 2.1"): "LGPL-2.1",
        gpl.format("Affero General Public License", "either version 3"): "AGPL-3.0",
    }
    found = notices([t.encode() for t in texts], KNOWN)
    assert [[n for n, *_ in f] for f in found] == [[n] for n in texts.values()]


def test_two_licenses_side_by_side():
    text = "Released under the MIT License. Licensed under the Apache License, Version 2.0. Licensed under CC BY 4.0."
    (found,) = notices([text.encode()], KNOWN)
    assert [n for n, *_ in found] == ["MIT", "Apache-2.0", "CC-BY-4.0"]


def test_repeated_notices():
    text = " ".join(["Released under the MIT License. Some words in between here now ok."] * 30)
    (found,) = notices([text.encode()], KNOWN)
    assert [n for n, *_ in found] == ["MIT"] * 30


def test_neighbouring_texts_do_not_mix():
    notice = TEMPLATES["GPL-3.0"][0].split()
    halves = [" ".join(notice[:6]).encode(), " ".join(notice[6:]).encode()]
    assert notices(halves, KNOWN) == [[], []]


def test_odd_rows(odd_docs, no_docs, docs_of):
    assert licenses(odd_docs).count() == 0
    assert licenses(no_docs).count() == 0
    rows = licenses(docs_of([(1, "Licensed under CC BY-NC 4.0."), (1, "Licensed under CC BY-NC 4.0."), (None, "x")])).collect()
    assert [tuple(r) for r in rows] == [(1, "CC-BY-NC-4.0", 0, 7, 1.0)] * 2
