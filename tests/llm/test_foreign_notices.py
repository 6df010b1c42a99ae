"""Notices of other licences, and notices that are denied: none may be confirmed."""

import pytest

from corpusloom.llm import licenses
from test_wrapped_notices import PROSE

FOREIGN = [
    "Licensed under the EUPL",
    "Licensed under the EUPL, Version 1.2.",
    "Licensed under the zlib License.",
    "Released under the zlib License.",
    "Licensed under the Apache License, Version 1.1.",
    "Licensed under the Open Software License 3.0.",
    "Released under the Vim License.",
    "Distributed under the Ruby License, Version 1.0.",
    "licensed under the laws of the state",
    "This work is licensed under the terms of the sale",
    "The doctor is licensed under the rules of the county.",
    "This Source Code Form is subject to the terms of the Netscape Public License, v. 1.0.",
    "This program and the accompanying materials are made available under the terms of the Common Public License 1.0",
    "Licensed under the GNU Free Documentation License, version 1.3.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "Licensed under CC BY-ND 4.0.",
    "not licensed under the MIT License",
    "This work is not licensed under the GNU General Public License, version 3.",
    "It was never released under the MIT License.",
    "This work is no longer licensed under a Creative Commons Attribution 4.0 International License.",
    "The files aren't licensed under the Apache License, Version 2.0.",
    "Redistribution in source and binary forms with modification are not permitted",
]


@pytest.fixture(scope="module")
def model():
    return licenses.train([PROSE, "the dog is under the tree and you can use it", "this is a note of the work with any of the files"] * 30)


@pytest.mark.parametrize("notice", FOREIGN)
def test_not_confirmed(model, notice):
    for text in (notice, f"{PROSE}\n{notice}\n{PROSE}", f"{PROSE} {notice} {PROSE}", notice.replace(" ", "\n")):
        assert not [f for _, f, _, confirmed in model.scan(text) if confirmed], text


@pytest.mark.parametrize("family, notice", [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts])
def test_own_notices_are(model, family, notice):
    for text in (notice, f"{PROSE}\n{notice}\n{PROSE}", f"It does not rain here today. {notice} No cat is here.", notice.upper()):
        assert [f for _, f, _, confirmed in model.scan(text) if confirmed] == [family], text


def test_rate_of_false_names_is_known(model):
    print(model.least, model.false_names)
    assert 0 <= model.false_names < 0.2
