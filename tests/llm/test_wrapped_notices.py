"""Notices that are wrapped over lines, as files hold them."""

import textwrap

import pytest

from corpusloom.llm import licenses

PROSE = "seven small birds sing in the old green tree by the river"
NOTICES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-SA": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


@pytest.fixture(scope="module")
def model():
    return licenses.train([PROSE, "the dog is under the tree and you can use it", "this is a note of the work with any of the files"] * 30)


@pytest.mark.parametrize("width", [40, 60, 72, 80])
@pytest.mark.parametrize("mark", ["", "# ", " * "])
@pytest.mark.parametrize("family", sorted(NOTICES))
def test_wrapped(model, family, mark, width):
    notice = "\n".join(mark + line for line in textwrap.wrap(NOTICES[family], width))
    for text in (notice, f"{PROSE}\n{notice}\n{PROSE}", f"{PROSE}\n\n{notice}\n\n{PROSE}"):
        assert {f for _, f, _, confirmed in model.scan(text) if confirmed} == {family}


def test_lines_keep_their_own_notices(model):
    text = f"Released under the MIT License.\nLicensed under CC BY 4.0.\n{PROSE}\n\n{PROSE}\n{PROSE}"
    assert [(n, f, c) for n, f, _, c in model.scan(text)] == [(0, "MIT", True), (1, "CC-BY", True)]
