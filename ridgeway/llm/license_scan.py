"""License notices in texts by ordered signature rules.

A rule is a regular expression over the lower-cased words of a text (joined by single
blanks), with a label, a priority, a weight and keywords. Rules are sentences of license
texts and file headers, written one by one, and forms in which a notice names one of a
list of licenses. A text is searched for all
keywords at once by an Aho-Corasick automaton; a rule runs if a keyword of its form
and one of its license occur. Where detections overlap, the one of higher priority stays, and a
detection that lies within a kept one is suppressed.

Three base phrases are reported wherever they stand; rules add labels to theirs.

Texts are independent: the work is a map over Arrow batches without any shuffle. Words
are counted for a whole batch at a time over its bytes.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import ship_package

# Phrase and label.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Licenses: label, expression of the name in words, keyword that any match contains,
# expression of the identifier in words.
FAMILIES = (
    ("mit", "mit", "mit", "mit"),
    ("mit-0", "mit no attribution", "attribution", "mit 0"),
    ("apache-1.1", "apache(?: software)?(?: version)? 1 1", "apache", "apache 1 1"),
    ("apache-2.0", "apache(?: software)?(?: license)?(?: version)?(?: 2(?: 0)?)", "apache", "apache 2 0"),
    ("bsd-2-clause", "(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause", "bsd", "bsd 2 clause"),
    ("bsd-3-clause", "(?:new|modified|revised|3 clause|three clause) bsd|bsd (?:3|three) clause", "bsd", "bsd 3 clause"),
    ("bsd-4-clause", "(?:original|4 clause|four clause) bsd|bsd (?:4|four) clause", "bsd", "bsd 4 clause"),
    ("0bsd", "(?:zero clause|0) bsd|0bsd", "bsd", "0bsd"),
    ("gpl-1.0", "(?:gnu )?(?:gpl|general public license)(?: version| v)? ?v?1(?: 0)?", "gpl|general", "gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "(?:gnu )?(?:gpl|general public license)(?: version| v)? ?v?2(?: 0)?", "gpl|general", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "(?:gnu )?(?:gpl|general public license)(?: version| v)? ?v?3(?: 0)?", "gpl|general", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.0", "(?:gnu )?(?:lgpl|library general public license)(?: version| v)? ?v?2(?: 0)?", "lgpl|library", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?v?2 1", "lgpl|lesser", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?v?3(?: 0)?", "lgpl|lesser", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", "(?:gnu )?(?:agpl|affero general public license)(?: version| v)? ?v?3(?: 0)?", "agpl|affero", "agpl 3 0(?: only| or later)?"),
    ("mpl-1.1", "(?:mpl|mozilla public license)(?: version| v)? ?v?1 1", "mpl|mozilla", "mpl 1 1"),
    ("mpl-2.0", "(?:mpl|mozilla public license)(?: version| v)? ?v?2(?: 0)?", "mpl|mozilla", "mpl 2 0"),
    ("epl-1.0", "(?:epl|eclipse public license)(?: version| v)? ?v?1(?: 0)?", "epl|eclipse", "epl 1 0"),
    ("epl-2.0", "(?:epl|eclipse public license)(?: version| v)? ?v?2(?: 0)?", "epl|eclipse", "epl 2 0"),
    ("cddl-1.0", "cddl(?: 1 0)?|common development and distribution license(?: 1 0)?", "cddl|development", "cddl 1 0"),
    ("cpl-1.0", "common public license(?: version)?(?: 1 0)?", "common", "cpl 1 0"),
    ("eupl-1.1", "(?:eupl|european union public licence)(?: version| v)? ?v?1 1", "eupl|european", "eupl 1 1"),
    ("eupl-1.2", "(?:eupl|european union public licence)(?: version| v)? ?v?1 2", "eupl|european", "eupl 1 2"),
    ("artistic-1.0", "artistic(?: license)? 1(?: 0)?", "artistic", "artistic 1 0"),
    ("artistic-2.0", "artistic(?: license)? 2(?: 0)?", "artistic", "artistic 2 0"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib(?: libpng)?", "zlib", "zlib"),
    ("bsl-1.0", "boost software(?: license)?(?: 1 0)?", "boost", "bsl 1 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl|do what the fuck you want to public", "wtfpl|fuck", "wtfpl"),
    ("psf-2.0", "(?:psf|python software foundation)(?: license)?(?: version)?(?: 2)?", "psf|python", "psf 2 0"),
    ("php-3.01", "php(?: license)?(?: version)? 3 01", "php", "php 3 01"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("ofl-1.1", "(?:sil )?open font(?: license)?(?: version)?(?: 1 1)?", "font", "ofl 1 1"),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa", "ncsa"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("cc0-1.0", "cc0|creative commons zero|cc zero", "cc0|zero", "cc0 1 0"),
    ("cc-by-3.0", "(?:cc|creative commons) (?:by|attribution) 3(?: 0)?", "cc|creative", "cc by 3 0"),
    ("cc-by-4.0", "(?:cc|creative commons) (?:by|attribution) 4(?: 0)?", "cc|creative", "cc by 4 0"),
    ("cc-by-sa", "(?:cc|creative commons) (?:by|attribution) (?:sa|share ?alike)", "cc|creative", "cc by sa \\d 0"),
    ("cc-by-nc", "(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial)", "cc|creative", "cc by nc \\d 0"),
    ("cc-by-nd", "(?:cc|creative commons) (?:by|attribution) (?:nd|no ?derivatives)", "cc|creative", "cc by nd \\d 0"),
    ("odbl-1.0", "(?:odbl|open database(?: license)?)(?: 1 0)?", "odbl|database", "odbl 1 0"),
    ("ms-pl", "(?:ms pl|microsoft public)", "ms|microsoft", "ms pl"),
    ("ms-rl", "(?:ms rl|microsoft reciprocal)", "ms|microsoft", "ms rl"),
    ("ecl-2.0", "educational community(?: license)?(?: version)?(?: 2 0)?", "educational", "ecl 2 0"),
    ("sspl-1.0", "(?:sspl|server side public)(?: license)?", "sspl|server", "sspl 1 0"),
    ("busl-1.1", "business source(?: license)?(?: 1 1)?", "business", "busl 1 1"),
    ("elastic-2.0", "elastic(?: license)?(?: 2 0)?", "elastic", "elastic 2 0"),
)
# Forms of a notice: keywords, expression around a license, priority, weight. ``{n}`` is
# the license's name, ``{i}`` its identifier.
FORMS = (
    ("spdx", r"spdx licen[sc]e identifier (?:{i})", 90, 1.0),
    ("under", r"(?:licen[sc]ed|released|distributed|published|available|provided|covered|redistributed) (?:as is )?under (?:the )?(?:terms of )?(?:the )?(?:{n})(?: licen[sc]e)?", 80, 0.95),
    ("subject|governed|according|accordance|compliance", r"(?:subject to|governed by|according to|in accordance with|compliance with) (?:the )?(?:terms of )?(?:the )?(?:{n})(?: licen[sc]e)?", 70, 0.9),
    ("licen", r"licen[sc]e (?:is |type )?(?:the )?(?:{n})(?: licen[sc]e)?", 50, 0.8),
    ("licen", r"(?:{n}) licen[sc]e", 40, 0.7),
    ("terms", r"terms of (?:the )?(?:{n})", 30, 0.6),
)
# Notices that name no license: label, expression, keywords, priority, weight.
NOTICES = (
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", "copyright", 20, 0.5),
    ("public-domain", r"(?:dedicated|released|placed|is) (?:to|into|in) the public domain", "domain", 60, 0.9),
    ("warranty", r"without warrant(?:y|ies) of any kind", "warrant", 20, 0.5),
    ("as-is", r"(?:provided|distributed) (?:on an )?as is(?: basis)?", "provided|distributed", 20, 0.5),
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby", 85, 1.0),
    ("bsd-3-clause", r"redistribution and use in source and binary forms with or without modification", "binary", 60, 0.8),
    ("gpl", r"gnu general public license", "gnu", 10, 0.6),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "confidential", 60, 0.9),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|distribution)", "unauthori", 55, 0.8),
)


# Sentences of license texts and file headers: label, expression, keyword, priority,
# weight. Each is written for one text; the tests have a passage for every one.
SENTENCES = (
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "portions", 84, 1.0),
    ("mit", r"deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense", "sublicense", 84, 1.0),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", "liable", 83, 0.9),
    ("mit-0", r"deal in the software without restriction .{0,160}permit persons to whom the software is furnished to do so the software is provided as is", "furnished", 86, 1.0),
    ("x11", r"the name of the x consortium shall not be used in advertising", "consortium", 84, 1.0),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "hereby", 85, 1.0),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)", "hereby", 84, 1.0),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose", "documentation", 83, 0.9),
    ("bsd-2-clause", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation", "redistributions", 62, 0.8),
    ("bsd-3-clause", r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products", "endorse", 88, 1.0),
    ("bsd-3-clause", r"the names? of the (?:authors?|copyright holders?) may not be used to endorse or promote products", "endorse", 87, 1.0),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising", 89, 1.0),
    ("bsd-3-clause-clear", r"no express or implied licenses to any party s patent rights are granted by this license", "patent", 88, 1.0),
    ("apache-1.1", r"the end user documentation included with the redistribution if any must include the following acknowledg?e?ment", "redistribution", 85, 1.0),
    ("apache-2.0", r"you may not use this file except in compliance with the license", "compliance", 84, 0.95),
    ("apache-2.0", r"you may obtain a copy of the license at https? www apache org licenses license 2 0", "apache", 88, 1.0),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "applicable", 84, 0.95),
    ("apache-2.0", r"grant of patent license subject to the terms and conditions of this license each contributor hereby grants", "patent", 85, 1.0),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1", "mozilla", 88, 1.0),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", 88, 1.0),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file you can obtain one at", "mpl", 87, 1.0),
    ("epl-1.0", r"the accompanying program is provided under the terms of this eclipse public license", "eclipse", 84, 0.95),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0", "eclipse", 88, 1.0),
    ("epl-1.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license v ?1 0", "eclipse", 88, 1.0),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development and distribution license", "development", 88, 1.0),
    ("cpl-1.0", r"the accompanying program is provided under the terms of this common public license", "common", 88, 1.0),
    ("lgpl", r"this library is distributed in the hope that it will be useful", "library", 70, 0.9),
    ("gpl", r"this program is distributed in the hope that it will be useful", "hope", 70, 0.9),
    ("gpl", r"you should have received a copy of the gnu general public license along with this program", "gnu", 75, 0.95),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license along with this library", "gnu", 76, 0.95),
    ("agpl", r"you should have received a copy of the gnu affero general public license along with this program", "affero", 76, 0.95),
    ("gpl-3.0", r"the gnu general public license is a free copyleft license for software and other kinds of works", "copyleft", 85, 1.0),
    ("agpl-3.0", r"specifically designed to ensure cooperation with the community in the case of network server software", "cooperation", 85, 1.0),
    ("gpl-2.0", r"activities other than copying distribution and modification are not covered by this license they are outside its scope", "modification", 85, 1.0),
    ("lgpl-2.1", r"a work that uses the library in isolation is not a derivative work of the library", "derivative", 85, 1.0),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "documentation", 88, 1.0),
    ("zlib", r"this notice may not be removed or altered from any source distribution", "altered", 84, 1.0),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented", "misrepresented", 84, 1.0),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "organization", 88, 1.0),
    ("bsl-1.0", r"distributed under the boost software license version 1 0 see accompanying file", "boost", 88, 1.0),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 88, 1.0),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", "verbatim", 88, 1.0),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "verbatim", 74, 0.9),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain", "deed", 88, 1.0),
    ("cc0-1.0", r"to the extent possible under law .{1,80}? has waived all copyright and related or neighboring rights", "waived", 88, 1.0),
    ("cc-by-4.0", r"this work is licensed under (?:a |the )?creative commons attribution 4 0 international", "creative", 88, 1.0),
    ("cc-by-sa-4.0", r"this work is licensed under (?:a |the )?creative commons attribution sharealike 4 0 international", "creative", 88, 1.0),
    ("cc-by-sa-3.0", r"this work is licensed under (?:a |the )?creative commons attribution sharealike 3 0", "creative", 88, 1.0),
    ("cc-by-nc-4.0", r"this work is licensed under (?:a |the )?creative commons attribution noncommercial 4 0 international", "creative", 88, 1.0),
    ("cc-by-nd-4.0", r"this work is licensed under (?:a |the )?creative commons attribution noderiv(?:ative)?s 4 0 international", "creative", 88, 1.0),
    ("cc-by-nc-sa-4.0", r"this work is licensed under (?:a |the )?creative commons attribution noncommercial sharealike 4 0 international", "creative", 88, 1.0),
    ("artistic-1.0", r"the intent of this document is to state the conditions under which a package may be copied", "intent", 86, 1.0),
    ("artistic-2.0", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed", "establishes", 88, 1.0),
    ("perl", r"(?:it|this program|this library) under the same terms as perl itself", "perl", 85, 1.0),
    ("ofl-1.1", r"this font software is licensed under the sil open font license version 1 1", "font", 88, 1.0),
    ("ofl-1.1", r"neither the font software nor any of its individual components in original or modified versions may be sold by itself", "font", 88, 1.0),
    ("psf-2.0", r"this license agreement is between the python software foundation psf and the individual or organization", "python", 88, 1.0),
    ("php-3.01", r"this product includes php software freely available from", "php", 88, 1.0),
    ("openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit", "openssl", 88, 1.0),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "agreement", 88, 1.0),
    ("ncsa", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimers in the documentation", "disclaimers", 86, 1.0),
    ("odbl-1.0", r"this .{1,60}? is made available under the open database license", "database", 88, 1.0),
    ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license", "governs", 84, 0.9),
    ("eupl-1.2", r"licensed under the eupl version 1 2 or as soon they will be approved by the european commission", "eupl", 88, 1.0),
    ("sspl-1.0", r"offering the program as a service .{0,40}you must make the service source code available", "offering", 86, 1.0),
    ("busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "licensor", 88, 1.0),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service", "hosted", 88, 1.0),
    ("commons-clause", r"the license does not include the right to sell the software", "sell", 84, 0.95),
    ("json", r"the software shall be used for good not evil", "evil", 88, 1.0),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer in return", "beer", 88, 1.0),
    ("llama", r"llama (?:2|3|3 1) community license agreement", "llama", 84, 0.95),
    ("openrail", r"(?:creativeml )?open ?rail(?: m| s| d)? licen[sc]e", "rail", 84, 0.9),
    ("proprietary", r"no part of this (?:publication|document|work|book) may be reproduced(?: stored| distributed| or transmitted)*", "reproduced", 58, 0.85),
    ("proprietary", r"this software is the confidential and proprietary information of", "confidential", 66, 0.9),
    ("proprietary", r"by (?:installing|downloading|using|accessing) (?:the |this )?software you agree to be bound by", "bound", 58, 0.8),
)
# The family of the GNU licenses: label, expression of the name, keyword, versions.
GNU = (
    ("gpl", "general public license", "general", ("1", "2", "3")),
    ("lgpl", "(?:lesser|library) general public license", "general", ("2", "2 1", "3")),
    ("agpl", "affero general public license", "affero", ("1", "3")),
)
# Forms of their headers: suffix of the label, expression, priority.
GNU_FORMS = (
    ("-or-later", r"(?:gnu )?{n} as published by the free software foundation (?:either )?version {v}(?: 0)?(?: of the license)? or (?:at your option )?any later version", 92),
    ("-only", r"(?:gnu )?{n} as published by the free software foundation version {v}(?: 0)?(?: of the license)? (?:only|exclusively)", 92),
    ("", r"(?:gnu )?{n} version {v}(?: 0)? as published by the free software foundation", 91),
    ("", r"(?:gnu )?{n} as published by the free software foundation version {v}(?: 0)?(?: of the license)?", 90),
    ("-or-later", r"(?:gnu )?{n}(?: version| v)? {v}(?: 0)? or (?:at your option )?(?:any )?later(?: version)?", 89),
    ("", r"version {v}(?: 0)? of the (?:gnu )?{n}", 86),
)


# Words that some base phrase contains.
BASE_GATE = frozenset({"cc", "public", "rights"})


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    form_words: frozenset[str]
    name_words: frozenset[str]
    priority: int
    weight: float


def _rule(label: str, text: str, forms: str, names: str, priority: int, weight: float) -> Rule:
    """Words of the text are separated by single blanks; nothing else is a border."""
    pattern = re.compile(rf"(?<![^ ])(?:{text})(?![^ ])")
    return Rule(label, pattern, frozenset(forms.split("|")), frozenset(names.split("|")), priority, weight)


def rules() -> list[Rule]:
    """All rules, highest priority first."""
    made = []
    for label, name, keyword, identifier in FAMILIES:
        for form, expression, priority, weight in FORMS:
            text = expression.format(n=name, i=identifier)
            # an identifier may be shorter than the name: its form word is telling enough
            made.append(_rule(label, text, form, form if form == "spdx" else keyword, priority, weight))
    for label, text, keyword, priority, weight in (*NOTICES, *SENTENCES):
        made.append(_rule(label, text, keyword, keyword, priority, weight))
    for label, name, keyword, versions in GNU:
        for version in versions:
            shown = version.replace(" ", ".") if " " in version else f"{version}.0"
            for suffix, form, priority in GNU_FORMS:
                text = form.format(n=name, v=version)
                made.append(_rule(f"{label}-{shown}{suffix}", text, keyword, keyword, priority, 1.0))
    return sorted(made, key=lambda r: -r.priority)


# A byte of the lower-cased text that is not part of a word becomes a blank; bytes
# from 0x80 on belong to characters that are all part of words.
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
_TABLE = bytes(c if _IN_WORD[c] else 32 for c in _LOWER)


class Scanner:
    """Rules and keyword automaton, built once per Python worker."""

    def __init__(self):
        self.rules = rules()
        self.form_words = frozenset().union(*(r.form_words for r in self.rules))
        self.gates = self.form_words | BASE_GATE
        self.automaton = ahocorasick.Automaton()
        for keyword in self.gates.union(*(r.name_words for r in self.rules)):
            self.automaton.add_word(keyword, keyword)
        self.automaton.make_automaton()
        self.base = [(phrase.split(), label) for phrase, label in BASE]

    def keywords(self, text: str) -> set[str]:
        return {keyword for _, keyword in self.automaton.iter(text)}

    def detections(self, text: str, keywords: set[str]) -> list[tuple[int, int, Rule]]:
        """Detections that stay, in characters of the word text."""
        if self.form_words.isdisjoint(keywords):
            return []
        hits = []
        for rule in self.rules:
            if not (rule.form_words.isdisjoint(keywords) or rule.name_words.isdisjoint(keywords)):
                hits += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(text)]
        return suppressed(hits)

    def base_places(self, words: list[str]) -> list[tuple[int, str]]:
        out = []
        for phrase, label in self.base:
            at = -1
            while True:
                try:
                    at = words.index(phrase[0], at + 1)
                except ValueError:
                    break
                if words[at : at + len(phrase)] == phrase:
                    out.append((at, label))
        return out


def suppressed(hits: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Higher priority first, then the longer, then the earlier; what overlaps a kept
    detection, or lies within one, goes. Kept ones are disjoint, so a look at the
    neighbours in order of position decides."""
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []
    for hit in sorted(hits, key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].label)):
        at = bisect_right(starts, hit[0])
        clear = (at == 0 or kept[at - 1][1] <= hit[0]) and (at == len(kept) or kept[at][0] >= hit[1])
        if clear:
            kept.insert(at, hit)
            starts.insert(at, hit[0])
    return kept


_scanner: list[Scanner] = []


def scanner() -> Scanner:
    if not _scanner:
        _scanner.append(Scanner())
    return _scanner[0]


def word_counts(raw: bytes, lengths: np.ndarray) -> np.ndarray:
    """Words of each of several texts (translated by ``_TABLE``) laid end to end."""
    if not len(raw):
        return np.zeros(len(lengths), "int64")
    inside = np.frombuffer(raw, "uint8") != 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = lengths.cumsum()
    starts = ends - lengths
    full = lengths > 0
    begins[starts[full]] = inside[starts[full]]
    so_far = np.concatenate([[0], np.cumsum(begins)])
    return so_far[ends] - so_far[starts]


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double, detections array<string>"
)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``.

    ``n_words``; ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` of the base
    phrases; ``labels``, base labels and those of kept detections; ``score``, the
    greatest weight of a detection, 1 for a base phrase, 0 without either; and
    ``detections`` as ``label:start:end`` in words.

    NULL texts count as empty: no words, no labels, score 0. Rows are independent, so
    repeated rows and NULL identifiers are as any other; other columns are not
    read; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = scanner()
        for batch in batches:
            raws = [(t or "").encode().translate(_TABLE) for t in batch["text"].to_pylist()]
            sizes = np.fromiter(map(len, raws), "int64", len(raws))
            counts = word_counts(b"".join(raws), sizes).tolist()
            rows = [_row(found, raw) for raw in raws]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), *columns], names=_NAMES
            )

    narrow = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(run, SCHEMA)


_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
_KINDS = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
_NOTHING = (0, None, None, "", "", 0.0, [])


def _row(found: Scanner, raw: bytes) -> tuple:
    keywords = found.keywords(raw.decode())
    if found.gates.isdisjoint(keywords):
        return _NOTHING
    # bytes were translated, so blanks are the only separators
    words = [w.decode() for w in raw.split(b" ") if w]
    base = found.base_places(words)
    text = " ".join(words)
    kept = found.detections(text, keywords)
    if not base and not kept:
        return _NOTHING
    labels = {label for _, label in base}
    places = [at for at, _ in base]
    begins = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist() if kept else []
    spans = [
        f"{rule.label}:{bisect_right(begins, a) - 1}:{bisect_right(begins, b - 1)}" for a, b, rule in kept
    ]
    score = max([1.0 if base else 0.0, *(rule.weight for *_, rule in kept)])
    return (
        len(base),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(labels)),
        ",".join(sorted(labels | {rule.label for *_, rule in kept})),
        score,
        spans,
    )
