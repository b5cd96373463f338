"""Every license rule finds a passage of its text, and none with its words changed."""

import re

import pytest

from ridgeway.llm import license_scan


def passage(expression):
    """A text that a rule's expression describes: first alternatives, optional parts in."""
    text = re.sub(r"\(\?[!<][^)]*\)", "", expression)
    text = re.sub(r"\.\{\d+,\d+\}\??", "acme corp", text).replace(r"\d", "1")
    while (group := re.search(r"\(\?:([^()]*)\)[?*]?", text)) is not None:
        text = text[: group.start()] + group.group(1).split("|")[0] + text[group.end() :]
    text = re.sub(r"\[(\w)\w*\]", r"\1", text)
    return re.sub(r"(\w| )\?", r"\1", text.split("|")[0]).strip()


@pytest.fixture(scope="module")
def scanner():
    return license_scan.Scanner()


def expressions(rule):
    return re.fullmatch(r"\(\?<!\[\^ \]\)\(\?:(.*)\)\(\?!\[\^ \]\)", rule.pattern.pattern).group(1)


def test_every_rule_has_a_passage_and_a_near_miss(scanner):
    assert len(scanner.rules) > 400
    for rule in scanner.rules:
        text = passage(expressions(rule))
        around = f"so {text} so"
        hit = rule.pattern.search(around)
        assert hit, (rule.label, text)
        keywords = scanner.keywords(around)
        assert not rule.form_words.isdisjoint(keywords) and not rule.name_words.isdisjoint(keywords), text
        found = scanner.detections(around, keywords)
        assert any(a < hit.end() and hit.start() < b for a, b, _ in found), text
        words = hit.group().split(" ")
        words = [w[:-1] + "qzq" if len(w) > 2 else w for w in words]
        assert not rule.pattern.search("so " + " ".join(words) + " so"), (rule.label, words)


def labels(scanner, text):
    return license_scan._row(scanner, text.encode().translate(license_scan._TABLE))[4]


def test_headers_of_the_gnu_licenses(scanner):
    head = "This program is free software; you can redistribute it and/or modify it under the terms of the "
    later = "; either version 2 of the License, or (at your option) any later version."
    published = " as published by the Free Software Foundation"
    assert labels(scanner, head + "GNU General Public License" + published + later) == "gpl,gpl-2.0-or-later"
    assert labels(scanner, head + "GNU Lesser General Public License" + published + "; version 2.1 of the License.") == "gpl,lgpl-2.1"
    assert labels(scanner, "the GNU Affero General Public License version 3 or later") == "agpl-3.0-or-later,gpl"
    assert labels(scanner, "Version 3 of the GNU General Public License") == "gpl,gpl-3.0"
    assert labels(scanner, "a gl pl general remark about the sale") == ""


def test_only_blanks_are_borders(scanner):
    assert labels(scanner, "licensed under the MIT license") == "mit"
    assert labels(scanner, "licensed under the MIT license") == ""
