"""Signature rules for licences, written over a text's words: lower-case, one blank between them, no punctuation.

``GNU GPL-2.0-or-later`` reads ``gnu gpl 2 0 or later`` there, an SPDX line ``spdx license identifier mit``, and a version
``2.0`` two words. A rule has gates, words of which any match must contain one: one word that all its alternatives share, or
one per alternative (``mit|expat``). A text without any of them never meets the rule's regular expression. Rules with a higher
priority suppress detections that lie within theirs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    gates: tuple[bytes, ...]
    pattern: re.Pattern
    priority: int
    weight: float
    base: bool = False

    @property
    def gate(self) -> bytes:
        return self.gates[0]


# Priorities: the more a signature says, the higher.
MENTION, NOTICE, VERSIONED, IDENTIFIER, FULL_TEXT = 10, 20, 30, 40, 50

_LEAD = r"(?:(?:is |are |be )?(?:dual )?(?:re)?(?:licen[cs]ed|released|distributed|available|provided|published|made available|covered|governed)"
_LEAD += r"(?: to you)?(?: for use)?(?: under| by| subject to| according to)(?: the)?(?: terms of)?(?: the)?(?: conditions of)?(?: the)?)"

_LEAD_UNDER = _LEAD.replace("| by|", "|")

# A family: label stem, gates, the name's forms, the versions with their label endings (none: the stem alone).
# v(1, 0) stands for a version as it is written: "1", "1 0", "v1 0", "version 1 0".
FAMILIES: tuple[tuple[str, str, str, tuple[tuple[str, str], ...]], ...] = (
    ("apache", "apache|asl", r"apache(?: software)?(?: licen[cs]e)?|asl", (("1.0", "1 0"), ("1.1", "1 1"), ("2.0", "2(?: 0)?"))),
    ("mit", "mit|expat", r"mit(?: x11)?(?: licen[cs]e)?|x11 mit(?: licen[cs]e)?|expat(?: mit)? licen[cs]e", ()),
    ("bsd", "bsd", r"(?:modified |new |simplified |revised |original )?bsd(?: style)?(?: licen[cs]e)?", (
        ("0-clause", "0 clause|zero clause"), ("1-clause", "1 clause|one clause"), ("2-clause", "2 clause|two clause"),
        ("3-clause", "3 clause|three clause"), ("4-clause", "4 clause|four clause"))),
    ("gpl", "gpl", r"(?:gnu )?gpl(?: licen[cs]e)?", (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"), ("3.0", "3(?: 0)?"))),
    ("gpl", "general", r"(?:the )?(?:gnu )?general public licen[cs]e(?: gpl)?", (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"), ("3.0", "3(?: 0)?"))),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: licen[cs]e)?", (("2.0", "2(?: 0)?"), ("2.1", "2 1"), ("3.0", "3(?: 0)?"))),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: lgpl)?", (("2.1", "2 1"), ("3.0", "3(?: 0)?"))),
    ("lgpl", "library", r"(?:gnu )?library general public licen[cs]e(?: lgpl)?", (("2.0", "2(?: 0)?"),)),
    ("agpl", "agpl", r"(?:gnu )?agpl(?: licen[cs]e)?", (("1.0", "1(?: 0)?"), ("3.0", "3(?: 0)?"))),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e(?: agpl)?", (("1.0", "1(?: 0)?"), ("3.0", "3(?: 0)?"))),
    ("fdl", "documentation", r"(?:gnu )?free documentation licen[cs]e(?: g?fdl)?", (("1.1", "1 1"), ("1.2", "1 2"), ("1.3", "1 3"))),
    ("fdl", "gfdl", r"(?:gnu )?gfdl", (("1.1", "1 1"), ("1.2", "1 2"), ("1.3", "1 3"))),
    ("mpl", "mozilla", r"mozilla public licen[cs]e(?: mpl)?", (("1.0", "1 0"), ("1.1", "1 1"), ("2.0", "2(?: 0)?"))),
    ("mpl", "mpl", r"mpl", (("1.0", "1 0"), ("1.1", "1 1"), ("2.0", "2(?: 0)?"))),
    ("epl", "eclipse", r"eclipse public licen[cs]e(?: epl)?", (("1.0", "1 0"), ("2.0", "2(?: 0)?"))),
    ("edl", "eclipse", r"eclipse distribution licen[cs]e(?: edl)?", (("1.0", "1(?: 0)?"),)),
    ("cddl", "cddl", r"cddl", (("1.0", "1 0"), ("1.1", "1 1"))),
    ("cddl", "development", r"common development and distribution licen[cs]e(?: cddl)?", (("1.0", "1 0"), ("1.1", "1 1"))),
    ("cpl", "common", r"common public licen[cs]e", (("0.5", "0 5"), ("1.0", "1 0"))),
    ("cpal", "attribution", r"common public attribution licen[cs]e(?: cpal)?", (("1.0", "1 0"),)),
    ("ipl", "ibm", r"ibm public licen[cs]e", (("1.0", "1 0"),)),
    ("eupl", "eupl", r"eupl", (("1.0", "1 0"), ("1.1", "1 1"), ("1.2", "1 2"))),
    ("eupl", "union", r"european union public licen[cs]e(?: eupl)?", (("1.0", "1 0"), ("1.1", "1 1"), ("1.2", "1 2"))),
    ("osl", "open", r"open software licen[cs]e(?: osl)?", (("1.0", "1 0"), ("2.0", "2 0"), ("2.1", "2 1"), ("3.0", "3 0"))),
    ("afl", "academic", r"academic free licen[cs]e(?: afl)?", (("1.1", "1 1"), ("1.2", "1 2"), ("2.0", "2 0"), ("2.1", "2 1"), ("3.0", "3 0"))),
    ("artistic", "artistic", r"(?:perl )?artistic licen[cs]e", (("1.0", "1 0"), ("2.0", "2(?: 0)?"))),
    ("isc", "isc", r"isc(?: licen[cs]e)", ()),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", ()),
    ("libpng", "libpng", r"libpng licen[cs]e", (("2.0", "2(?: 0)?"),)),
    ("bsl", "boost", r"boost software licen[cs]e", (("1.0", "1(?: 0)?"),)),
    ("busl", "business", r"business source licen[cs]e", (("1.1", "1 1"),)),
    ("sspl", "server", r"server side public licen[cs]e(?: sspl)?", (("1.0", "1(?: 0)?"),)),
    ("elastic", "elastic", r"elastic licen[cs]e", (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"))),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", "wtfpl", r"wtfpl", (("1", "1"), ("2", "2"))),
    ("cc0", "cc0", r"cc0(?: universal)?", (("1.0", "1 0(?: universal)?"),)),
    ("psf", "psf", r"psf(?: licen[cs]e(?: agreement)?)?", (("2.0", "2(?: 0)?"),)),
    ("python", "python", r"python(?: software foundation)? licen[cs]e", (("2.0", "2(?: 0)?"),)),
    ("php", "php", r"php licen[cs]e", (("3.0", "3 0"), ("3.01", "3 01"))),
    ("ruby", "ruby", r"ruby licen[cs]e", ()),
    ("vim", "vim", r"vim licen[cs]e", ()),
    ("openssl", "openssl", r"openssl licen[cs]e", ()),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e", ()),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", ()),
    ("curl", "curl", r"curl licen[cs]e", ()),
    ("w3c", "w3c", r"w3c(?: software)?(?: notice and)? licen[cs]e", ()),
    ("ofl", "ofl", r"(?:sil )?ofl", (("1.0", "1 0"), ("1.1", "1 1"))),
    ("ofl", "font", r"(?:sil )?open font licen[cs]e(?: ofl)?", (("1.0", "1 0"), ("1.1", "1 1"))),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e(?: ms pl)?", ()),
    ("ms-rl", "reciprocal", r"microsoft reciprocal licen[cs]e(?: ms rl)?", ()),
    ("qpl", "qpl", r"(?:q public licen[cs]e )?qpl", (("1.0", "1 0"),)),
    ("zpl", "zope", r"zope public licen[cs]e(?: zpl)?", (("1.1", "1 1"), ("2.0", "2 0"), ("2.1", "2 1"))),
    ("odbl", "database", r"open database licen[cs]e(?: odbl)?", (("1.0", "1 0"),)),
    ("odc-by", "commons", r"open data commons attribution licen[cs]e", (("1.0", "1 0"),)),
    ("pddl", "dedication", r"(?:open data commons )?public domain dedication and licen[cs]e(?: pddl)?", (("1.0", "1 0"),)),
    ("cecill", "cecill", r"cecill(?: free software)?(?: licen[cs]e)?(?: agreement)?", (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"), ("2.1", "2 1"))),
    ("mulan-psl", "mulan", r"mulan(?: permissive)?(?: software)? (?:psl|licen[cs]e)", (("1.0", "1(?: 0)?"), ("2.0", "2(?: 0)?"))),
    ("blueoak", "blue", r"blue oak model licen[cs]e", (("1.0.0", "1 0 0"),)),
    ("hippocratic", "hippocratic", r"hippocratic licen[cs]e", (("2.1", "2 1"), ("3.0", "3 0"))),
    ("commons-clause", "clause", r"commons clause", (("1.0", "1 0"),)),
)

# Names that are words of a language, too: such a name alone is no mention, a licence word must stand next to it.
# Given are the forms that no text has by chance.
ORDINARY = {
    "mit": r"mit x11|x11 mit|expat(?: mit)? licen[cs]e",
    "apache": r"apache software licen[cs]e",
}

# Creative Commons: the conditions in the order of their short names, and how they are written out.
CONDITIONS = (
    ("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"),
    ("by-nd", "attribution no ?deriv(?:ative)?s?(?: works)?"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Phrases that only a licence's own text has.
TEXTS: tuple[tuple[str, str, str], ...] = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "merchantability", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "endorse", r"neither the names? of (?:[^ ]+ ){1,12}?may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", "reproduction", r"terms and conditions for use reproduction and distribution"),
    ("gpl", "redistribute", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "redistribute", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    ("gpl", "copy", r"you should have received a copy of the gnu general public licen[cs]e"),
    ("gpl-3.0", "copyleft", r"the gnu general public licen[cs]e is a free copyleft licen[cs]e for software and other kinds of works"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("epl", "accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", "warranty", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("bsl-1.0", "organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    ("cc0-1.0", "waived", r"has waived all copyright and related or neighboring rights to"),
    ("artistic", "package", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("ofl", "font", r"this font software is licensed under the sil open font licen[cs]e"),
    ("apache-2.0", "applicable", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis"),
    ("mit", "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "liable", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("bsd", "retain", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "reproduce", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "holders", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("gpl", "hope", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "hope", r"this library is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed"),
    ("gpl-2.0", "freedom", r"the licen[cs]es for most software are designed to take away your freedom to share and change it"),
    ("agpl-3.0", "cooperation", r"specifically designed to ensure cooperation with the community in the case of network server software"),
    ("lgpl-3.0", "incorporates", r"this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3"),
    ("fdl", "document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("mpl-2.0", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("cddl", "contents", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("ofl", "font", r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("ofl", "worldwide", r"the goals of the open font licen[cs]e ofl are to stimulate worldwide development of collaborative font projects"),
    ("cc0", "deed", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("isc", "disclaims", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("zlib", "granted", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("bsl-1.0", "derivative", r"must be included in all copies of the software in whole or in part and all derivative works of the software"),
    ("wtfpl", "verbatim", r"everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document"),
    ("psf", "python", r"psf is making python(?: [0-9]+){0,3} available to licensee on an as is basis"),
    ("php", "php", r"this product includes php software freely available from"),
    ("openssl", "openssl", r"this product includes (?:cryptographic )?software developed by the openssl project"),
    ("artistic-2.0", "establishes", r"this licen[cs]e establishes the terms under which a given free software package may be copied modified distributed"),
    ("busl-1.1", "licensor", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl-1.0", "functionality", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("commons-clause", "grant", r"the licen[cs]e does not grant to you the right to sell the software"),
    ("ncsa", "deal", r"to deal with the software without restriction"),
    ("postgresql", "agreement", r"for any purpose without fee and without a written agreement is hereby granted"),
    ("json", "evil", r"the software shall be used for good not evil"),
    ("beerware", "beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("public-domain", "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "unauthorized|unauthorised", r"unauthori[sz]ed (?:copying|use|reproduction|distribution) (?:of this (?:file|work|software) )?(?:via any medium )?is strictly prohibited"),
    ("proprietary", "permission", r"(?:may not be|no part of this (?:work|publication|book) may be) reproduced (?:[^ ]+ ){0,12}?without (?:the )?(?:prior )?(?:express )?(?:written )?permission"),
    ("copyright", "copyright", r"copyright (?:c )?(?:1[89][0-9]{2}|20[0-9]{2})(?: (?:1[89][0-9]{2}|20[0-9]{2}|present)){0,3}"),
)

# The phrases that every scan reports, whatever else it finds.
BASE = (("cc-by", "cc", "cc by"), ("gpl", "general", "general public license"), ("reserved", "reserved", "all rights reserved"))
# end of fixed values


def _rule(label: str, gates: str, body: str, priority: int, weight: float, base: bool = False) -> Rule:
    return Rule(label, tuple(gates.encode().split(b"|")), re.compile(rf"(?<![^ ])(?:{body})(?![^ ])".encode()), priority, weight, base)


def _version(body: str) -> str:
    return rf"(?:version |v ?)?(?:{body})"


def _family_rules() -> list[Rule]:
    rules = []
    for stem, gate, name, versions in FAMILIES:
        alone = ORDINARY.get(stem, name)
        # something may be provided by anybody, but only under a licence
        lead = rf"{_LEAD_UNDER if stem in ORDINARY else _LEAD} (?:an? )?(?:{name})"
        rules.append(_rule(stem, gate, rf"(?:{name}) licen[cs]ed?|(?:licen[cs]e|licen[cs]ed) (?:{name})|{alone}", MENTION, 0.3))
        rules.append(_rule(stem, gate, rf"{lead}(?: licen[cs]e)?", NOTICE, 0.7))
        rules.append(_rule(stem, gate, rf"spdx licen[cs]e identifier (?:{name})", IDENTIFIER, 0.95))
        for ending, body in versions:
            label, tail = f"{stem}-{ending}", rf"(?: only| or later| or any later version| or newer)?"
            named = rf"(?:{name}) {_version(body)}{tail}"
            # "bsd 3 clause license" and "3 clause bsd license"
            turned = rf"|(?:{body}) (?:{name})" if "clause" in ending else ""
            rules.append(_rule(label, gate, rf"(?:{named}{turned})(?: licen[cs]e)?", VERSIONED, 0.6))
            rules.append(_rule(label, gate, rf"{lead} {_version(body)}{tail}", VERSIONED + 5, 0.9))
            rules.append(_rule(label, gate, rf"spdx licen[cs]e identifier (?:{name}) (?:{body}){tail}", IDENTIFIER + 5, 0.99))
    return rules


def _creative_commons_rules() -> list[Rule]:
    rules = [_rule("cc", "creative", r"creative commons(?: licen[cs]e)?", MENTION, 0.4)]
    for short, long in CONDITIONS:
        spelled = short.replace("-", " ")
        rules.append(_rule(f"cc-{short}", "cc", rf"cc {spelled}", MENTION, 0.5))
        rules.append(_rule(f"cc-{short}", "creative", rf"creative commons (?:{long})(?: licen[cs]e)?", NOTICE, 0.7))
        rules.append(_rule(f"cc-{short}", "creativecommons", rf"creativecommons org licenses {spelled}", NOTICE, 0.8))
        rules.append(_rule(f"cc-{short}", "cc", rf"{_LEAD} (?:an? )?cc {spelled}(?: licen[cs]e)?", NOTICE, 0.7))
        for version in CC_VERSIONS:
            digits, label = version.replace(".", " "), f"cc-{short}-{version}"
            rules.append(_rule(label, "cc", rf"cc {spelled} {_version(digits)}(?: international| unported| generic)?", VERSIONED, 0.8))
            rules.append(_rule(label, "cc", rf"{_LEAD} (?:an? )?cc {spelled} {_version(digits)}", VERSIONED + 5, 0.95))
            written = rf"creative commons (?:{long}) {digits}(?: international| unported| generic)?(?: licen[cs]e)?"
            rules.append(_rule(label, "creative", written, VERSIONED, 0.9))
            rules.append(_rule(label, "creativecommons", rf"creativecommons org licenses {spelled} {digits}", VERSIONED, 0.9))
    return rules


def build_rules() -> tuple[Rule, ...]:
    base = [_rule(label, gate, body, NOTICE, 0.5, base=True) for label, gate, body in BASE]
    texts = [_rule(label, gate, body, FULL_TEXT, 0.97) for label, gate, body in TEXTS]
    return (*base, *texts, *_family_rules(), *_creative_commons_rules())


RULES = build_rules()
