"""License scans by ordered signature rules.

A text is reduced to its lower-case words. Hundreds of regexes run only where their keywords occur: signatures of
licence bodies, headers and links written one by one, and references, which are the names of licences in the phrasings
that cite them. Their detections are then taken by priority, the longer first, and one whose interval lies inside an
accepted interval is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, frugal

#: Base phrases and their labels (fixed values).
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: label, keywords of which each name holds one, names as regexes over words (fixed values).
LICENSES = [
    ("mit", "mit|expat", r"mit|expat"),
    ("mit-0", "mit", r"mit no attribution|mit 0"),
    ("x11", "x11", r"x11|mit x11"),
    ("apache-2", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?1 1"),
    ("gpl-1", "general", r"(?:gnu )?general public license(?: version| v)? ?1"),
    ("gpl-2", "general", r"(?:gnu )?general public license(?: version| v)? ?2"),
    ("gpl-3", "general", r"(?:gnu )?general public license(?: version| v)? ?3"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl(?: version| v)? ?2|gplv2"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl(?: version| v)? ?3|gplv3"),
    ("lgpl-2", "lesser|library", r"(?:gnu )?(?:lesser|library) general public license(?: version| v)? ?2(?: 0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? ?2 1"),
    ("lgpl-3", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? ?3"),
    ("lgpl-2.1", "lgpl", r"lgpl(?: version| v)? ?2 1|lgplv2 1"),
    ("lgpl-3", "lgpl", r"lgpl(?: version| v)? ?3|lgplv3"),
    ("agpl-3", "affero", r"(?:gnu )?affero general public license(?: version| v)? ?3"),
    ("agpl-3", "agpl", r"agpl(?: version| v)? ?3|agplv3"),
    ("gfdl-1.3", "documentation", r"(?:gnu )?free documentation license(?: version| v)? ?1 3"),
    ("gfdl-1.2", "documentation", r"(?:gnu )?free documentation license(?: version| v)? ?1 2"),
    ("bsd-2", "bsd|simplified", r"(?:simplified|freebsd|bsd 2 clause|2 clause bsd)(?: bsd)?"),
    ("bsd-3", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)"),
    ("bsd-4", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)"),
    ("0bsd", "0bsd|zero clause", r"zero clause bsd|0bsd"),
    ("isc", "isc", r"isc"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? ?1 1"),
    ("mpl-2", "mozilla", r"mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("mpl-2", "mpl", r"mpl(?: version| v)? ?2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("edl-1", "eclipse", r"eclipse distribution license(?: version| v)? ?1(?: 0)?"),
    ("cddl-1", "cddl|common", r"cddl(?: version| v)? ?1(?: 0)?|common development and distribution license"),
    ("cpl-1", "common", r"common public license(?: version| v)? ?1(?: 0)?"),
    ("artistic-1", "artistic", r"artistic license(?: version| v)? ?1(?: 0)?"),
    ("artistic-2", "artistic", r"artistic license(?: version| v)? ?2(?: 0)?"),
    ("boost-1", "boost", r"boost software license(?: version| v)?(?: ?1(?: 0)?)?"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("libpng", "libpng", r"libpng"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl|fuck", r"wtfpl|do what the fuck you want to public license"),
    ("python-2", "python", r"python(?: software foundation)? license(?: version| v)? ?2"),
    ("php-3", "php", r"php license(?: version| v)? ?3(?: 0 ?1?)?"),
    ("ruby", "ruby", r"ruby"),
    ("openssl", "openssl", r"openssl"),
    ("postgresql", "postgresql", r"postgresql"),
    ("ncsa", "ncsa", r"university of illinois ncsa|ncsa"),
    ("ofl-1.1", "font", r"sil open font license(?: version| v)? ?1 1"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("eupl-1.1", "eupl", r"eupl(?: version| v)? ?1 1"),
    ("eupl-1.2", "eupl|european", r"eupl(?: version| v)? ?1 2|european union public licen[cs]e(?: version| v)? ?1 2"),
    ("odbl-1", "database", r"open (?:data commons open )?database license(?: version| v)?(?: ?1(?: 0)?)?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by", "cc", r"cc by(?: \d 0)?"),
    ("cc-by-sa", "cc", r"cc by sa(?: \d 0)?"),
    ("cc-by-nd", "cc", r"cc by nd(?: \d 0)?"),
    ("cc-by-nc", "cc", r"cc by nc(?: \d 0)?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: \d 0)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: \d 0)?"),
    ("cc-by", "creative", r"creative commons attribution(?: \d 0)?"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: \d 0)?"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s(?: \d 0)?"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial(?: \d 0)?"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike(?: \d 0)?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: \d 0)?"),
]

#: priority, score, further keyword, phrasing (fixed values).
PHRASINGS = [
    (90, 1.0, "spdx", r"spdx license identifier (?:{})"),
    (80, 0.95, "licens", r"licensed under (?:the )?(?:terms of (?:the )?)?(?:{})(?: licen[cs]e)?"),
    (70, 0.9, "under", r"(?:released|distributed|published|available|provided|covered|redistributable) under (?:the )?(?:terms of (?:the )?)?(?:{})(?: licen[cs]e)?"),
    (60, 0.7, "licen", r"(?:{}) licen[cs]e"),
    (50, 0.6, "licen", r"licen[cs]e (?:is )?(?:the )?(?:{})"),
]

_GRANT = "permission is hereby granted free of charge to any person"
_PERMIT = "permission to use copy modify and(?: or)? distribute this software"
_FREE = "is free software you can redistribute it and or modify it under the terms of the"
_SUBJECT = "contents of this file are subject to the"
_HOPE = "is distributed in the hope that it will be useful but without any warranty"
#: Signatures of licence bodies, headers and links: label, priority, score, keyword, regex (fixed values).
SIGNATURES = [
    ("mit", 88, 0.95, "associated documentation", rf"{_GRANT} obtaining a copy of this software and associated documentation files(?: the software)?(?: to deal in the software without restriction)?"),
    ("mit", 66, 0.8, "sublicense", r"(?:including without limitation )?the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", 65, 0.7, "substantial portions", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 64, 0.6, "copyright holders be liable", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", 67, 0.9, "except as contained", r"except as contained in this notice the names? of (?:\S+ ){1,8}shall not be used in advertising"),
    ("ncsa", 89, 0.95, "deal with the software", rf"{_GRANT} obtaining a copy of this software and associated documentation files(?: the software)? to deal with the software without restriction"),
    ("json", 70, 0.95, "good not evil", r"the software shall be used for good not evil"),
    ("isc", 84, 0.95, "with or without fee", rf"{_PERMIT} for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0bsd", 83, 0.9, "with or without fee", rf"{_PERMIT} for any purpose with or without fee is hereby granted(?! provided)"),
    ("postgresql", 86, 0.95, "written agreement", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", 82, 0.8, "its documentation", r"permission to use copy modify (?:and )?(?:distribute )?(?:and sell )?this software and its documentation for any purpose"),
    ("bsd-any", 60, 0.8, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?"),
    ("bsd-any", 58, 0.7, "list of conditions", r"redistributions of source code must retain the above copyright notice this list of conditions"),
    ("bsd-any", 58, 0.7, "binary form must", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3", 72, 0.9, "endorse or promote", r"neither the names? of (?:\S+ ){1,14}may be used to endorse or promote products"),
    ("bsd-3", 71, 0.85, "endorse or promote", r"the names? of (?:\S+ ){1,8}may not be used to endorse or promote products"),
    ("bsd-4", 73, 0.95, "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-any", 57, 0.6, "this software is provided by", r"this software is provided by (?:the )?(?:\S+ ){1,6}as is and any express or implied warranties"),
    ("bsd-3-clear", 74, 0.9, "patent rights are granted", r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("apache-2", 87, 0.95, "apache", r"apache license version 2 0 january 2004"),
    ("apache-2", 78, 0.9, "licenses license 2 0", r"(?:www )?apache org licenses license 2 0"),
    ("apache-2", 63, 0.7, "except in compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2", 62, 0.6, "agreed to in writing", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", 76, 0.9, "contributor license agreements", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-1.1", 77, 0.8, "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("gpl-1", 86, 0.95, "february 1989", r"gnu general public license version 1 february 1989"),
    ("gpl-2", 86, 0.95, "june 1991", r"gnu general public license version 2 june 1991"),
    ("gpl-3", 86, 0.95, "june 2007", r"gnu general public license version 3 29 june 2007"),
    ("gpl-2", 85, 0.95, "free software", rf"{_FREE} gnu general public license as published by the free software foundation (?:either )?version 2(?: of the license)?(?: or at your option any later version)?"),
    ("gpl-3", 85, 0.95, "free software", rf"{_FREE} gnu general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or at your option any later version)?"),
    ("gpl-any", 56, 0.7, "free software", rf"{_FREE} gnu general public license"),
    ("gpl-any", 45, 0.5, "along with", r"you should have received a copy of the gnu general public license along with"),
    ("gpl-any", 44, 0.4, "will be useful", rf"this program {_HOPE}"),
    ("gpl-any", 54, 0.7, "take away your freedom", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3", 75, 0.9, "copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-2", 79, 0.9, "gnu org", r"gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3", 79, 0.9, "gnu org", r"gnu org licenses gpl 3 0"),
    ("classpath-exception", 61, 0.8, "special exception", r"as a special exception the copyright holders of this library give you permission to link this library"),
    ("gcc-exception", 61, 0.8, "runtime library exception", r"gcc runtime library exception(?: version 3 1)?"),
    ("lgpl-2", 87, 0.95, "june 1991", r"gnu library general public license version 2 june 1991"),
    ("lgpl-2.1", 87, 0.95, "february 1999", r"gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3", 87, 0.95, "june 2007", r"gnu lesser general public license version 3 29 june 2007"),
    ("lgpl-2.1", 85, 0.95, "free software", rf"{_FREE} gnu lesser general public license as published by the free software foundation (?:either )?version 2 1"),
    ("lgpl-3", 85, 0.95, "free software", rf"{_FREE} gnu lesser general public license as published by the free software foundation (?:either )?version 3"),
    ("lgpl-any", 55, 0.7, "free software", rf"{_FREE} gnu (?:lesser|library) general public license"),
    ("lgpl-any", 43, 0.4, "will be useful", rf"this library {_HOPE}"),
    ("agpl-3", 87, 0.95, "november 2007", r"gnu affero general public license version 3 19 november 2007"),
    ("agpl-3", 85, 0.95, "affero", rf"{_FREE} gnu affero general public license"),
    ("agpl-3", 68, 0.8, "remote network", r"remote network interaction use with the gnu general public license"),
    ("gfdl-any", 80, 0.9, "modify this document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl-any", 46, 0.5, "invariant sections", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-1.0", 81, 0.95, "mozilla", rf"{_SUBJECT} mozilla public license version 1 0"),
    ("mpl-1.1", 81, 0.95, "mozilla", rf"{_SUBJECT} mozilla public license version 1 1"),
    ("mpl-2", 81, 0.95, "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", 69, 0.8, "of the mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2", 68, 0.8, "secondary licenses", r"this source code form is incompatible with secondary licenses"),
    ("npl-1.1", 81, 0.95, "netscape", rf"{_SUBJECT} netscape public license version 1 1"),
    ("epl-1", 81, 0.95, "eclipse", r"are made available under the terms of the eclipse public license v ?1 0"),
    ("epl-2", 81, 0.95, "eclipse", r"are made available under the terms of the eclipse public license (?:v ?)?2 0"),
    ("epl-any", 53, 0.7, "eclipse", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("cddl-1", 81, 0.95, "common development", rf"{_SUBJECT} terms of the common development and distribution license"),
    ("cpl-1", 80, 0.9, "common public license", r"the accompanying program is provided under the terms of this common public license"),
    ("ipl-1", 80, 0.9, "ibm public license", r"the accompanying program is provided under the terms of this ibm public license"),
    ("apsl-2", 80, 0.9, "apple public source", r"(?:subject to|terms of) the apple public source license(?: version 2 0)?"),
    ("artistic-1", 70, 0.9, "package may be copied", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2", 70, 0.9, "perl foundation", r"the artistic license 2 0 copyright c 2000 2006 the perl foundation"),
    ("perl", 69, 0.9, "same terms as perl", r"(?:redistribute it and or modify it )?under the same terms as perl (?:5 )?itself"),
    ("boost-1", 88, 0.95, "person or organization", rf"{_GRANT} or organization obtaining a copy of the software and accompanying documentation"),
    ("boost-1", 75, 0.9, "boost org", r"boost org license 1 0(?: txt)?"),
    ("zlib", 70, 0.9, "misrepresented", r"the origin of this software must not be misrepresented(?: you must not claim that you wrote the original software)?"),
    ("zlib", 69, 0.85, "plainly marked", r"altered source versions must be plainly marked as such"),
    ("zlib", 52, 0.6, "held liable", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", 84, 0.95, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 71, 0.85, "anyone is free", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 72, 0.9, "fuck", r"you just do what the fuck you want to"),
    ("beerware", 72, 0.95, "buy me a beer", r"you can buy me a beer in return"),
    ("blessing", 72, 0.95, "forgive others", r"may you find forgiveness for yourself and forgive others"),
    ("cc0", 82, 0.95, "publicdomain zero", r"creativecommons org publicdomain zero 1 0"),
    ("cc-pdm", 82, 0.95, "publicdomain mark", r"creativecommons org publicdomain mark 1 0"),
    ("cc0", 70, 0.9, "associated a work", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", 78, 0.95, "creativecommons", r"creativecommons org licenses by \d \d"),
    ("cc-by-sa", 78, 0.95, "creativecommons", r"creativecommons org licenses by sa \d \d"),
    ("cc-by-nd", 78, 0.95, "creativecommons", r"creativecommons org licenses by nd \d \d"),
    ("cc-by-nc", 78, 0.95, "creativecommons", r"creativecommons org licenses by nc \d \d"),
    ("cc-by-nc-sa", 78, 0.95, "creativecommons", r"creativecommons org licenses by nc sa \d \d"),
    ("cc-by-nc-nd", 78, 0.95, "creativecommons", r"creativecommons org licenses by nc nd \d \d"),
    ("cc-any", 50, 0.6, "redistribute the material", r"you are free to share copy and redistribute the material in any medium or format"),
    ("cc-nc-any", 51, 0.6, "commercial purposes", r"you may not use the material for commercial purposes"),
    ("cc-sa-any", 51, 0.6, "build upon", r"if you remix transform or build upon the material you must distribute your contributions under the same license"),
    ("cc-nd-any", 51, 0.6, "build upon", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("odbl-1", 75, 0.9, "open database license", r"this (?:\S+ ){1,6}is made available under the open database license"),
    ("odc-by", 75, 0.9, "open data commons", r"open data commons attribution license"),
    ("pddl", 75, 0.9, "open data commons", r"open data commons public domain dedication and licen[cs]e"),
    ("ofl-1.1", 81, 0.95, "font software", r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl-any", 60, 0.8, "stimulate worldwide", r"the goals of the open font license ofl are to stimulate worldwide development"),
    ("python-2", 75, 0.9, "psf is making", r"psf is making python available to licensee on an as is basis"),
    ("php-3", 75, 0.9, "php software", r"this product includes php software freely available from"),
    ("openssl", 75, 0.9, "openssl", r"this product includes software developed by the openssl project"),
    ("ssleay", 75, 0.9, "eric young", r"this product includes cryptographic software written by eric young"),
    ("ijg", 75, 0.9, "jpeg group", r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", 75, 0.9, "freetype", r"portions of this software are copyright (?:c )?(?:\d{4} )?the freetype project"),
    ("unicode", 75, 0.9, "unicode inc", r"unicode inc license agreement data files and software"),
    ("vim", 75, 0.9, "charityware", r"vim is charityware"),
    ("ms-pl", 74, 0.9, "accompanying software", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("eupl-any", 60, 0.8, "eupl", r"licensed under the eupl"),
    ("busl-1.1", 80, 0.95, "business source", r"business source license 1 1"),
    ("sspl-1", 80, 0.95, "server side public", r"server side public license(?: version 1)?"),
    ("elastic-2", 80, 0.95, "elastic license", r"elastic license(?: version)? 2 0"),
    ("commons-clause", 80, 0.95, "commons clause", r"commons clause license condition v1 0"),
    ("polyform-nc", 80, 0.95, "polyform", r"polyform noncommercial license 1 0 0"),
    ("openrail-m", 80, 0.95, "rail", r"(?:creativeml|bigscience|bigcode) open ?rail m"),
    ("llama-2", 80, 0.95, "llama 2", r"llama 2 community license agreement"),
    ("llama-3", 80, 0.95, "llama 3", r"(?:meta )?llama 3(?: \d)? community license agreement"),
    ("gemma", 80, 0.95, "gemma", r"gemma terms of use"),
    ("proprietary", 60, 0.8, "unauthorized copying", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", 60, 0.8, "proprietary", r"(?:this software is |contains )(?:the )?confidential and proprietary information of"),
    ("proprietary", 59, 0.7, "proprietary and confidential", r"proprietary and confidential"),
    ("proprietary", 59, 0.7, "reproduced", r"no part of this (?:publication|book|document|work) may be reproduced(?: stored in a retrieval system)?"),
    ("noncommercial", 58, 0.7, "commercial", r"(?:for )?non ?commercial (?:research )?use only"),
    ("personal-use", 58, 0.7, "personal use", r"for (?:your )?personal use only"),
    ("no-warranty", 35, 0.3, "warranty of any kind", r"(?:the software is )?provided as is without warranty of any kind"),
]

#: Rules that name no licence: label, priority, score, keyword, regex (fixed values).
GENERAL = [
    ("all-rights-reserved", 40, 0.5, "reserved", r"all rights reserved"),
    ("public-domain", 40, 0.5, "domain", r"(?:dedicated to|released (?:in)?to|in) the public domain"),
    ("copyright", 30, 0.3, "copyright", r"copyright (?:c )?\d{4}(?: \d{4})*"),
    ("gpl-any", 20, 0.4, "general", r"(?:gnu )?general public license"),
    ("apache-any", 20, 0.4, "apache", r"apache license"),
    ("cc-any", 20, 0.4, "creative", r"creative commons license"),
]


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    score: float
    keywords: tuple[tuple[bytes, ...], ...]
    pattern: re.Pattern


def any_of(keywords: str) -> tuple[bytes, ...]:
    return tuple(keywords.encode().split(b"|"))


def rules() -> list[Rule]:
    """All rules, highest priority first: the signatures, every licence name in every phrasing, the general ones."""
    made = [Rule(label, p, s, (any_of(key), any_of(also)), re.compile(b" (?:" + phrase.format(name).encode() + b")(?= )")) for p, s, also, phrase in PHRASINGS for label, key, name in LICENSES]
    made += [Rule(label, p, s, (any_of(key),), re.compile(b" (?:" + r.encode() + b")(?= )")) for label, p, s, key, r in SIGNATURES + GENERAL]
    return sorted(made, key=lambda r: -r.priority)


_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Scanner:
    """Scans one text at a time. One automaton finds the keywords of all rules; a rule runs only on texts that hold one
    of each group of its keywords."""

    def __init__(self, phrases: dict[str, str] | None = None):
        self.phrases = {f" {p} ".encode(): label for p, label in (phrases or BASE_PHRASES).items()}
        self.by_keywords: dict[tuple[tuple[bytes, ...], ...], list[Rule]] = {}
        self.prefilter = ahocorasick.Automaton()
        for r in rules():
            self.by_keywords.setdefault(r.keywords, []).append(r)
            for k in (k for group in r.keywords for k in group):
                self.prefilter.add_word(k.decode(), k)
        self.prefilter.make_automaton()

    def scan(self, text: str | None) -> dict:
        parts = (text or "").encode("utf-8", "replace").translate(_TABLE).split()
        out = {"n_words": len(parts), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "detections": []}
        low = b" " + b" ".join(parts) + b" "
        places, base = [], set()
        for phrase, label in self.phrases.items():
            at = low.find(phrase)
            while at >= 0:
                places.append(at)
                base.add(label)
                at = low.find(phrase, at + 1)
        found = self.detect(low)
        if not places and not found:
            return out
        if places:
            out |= {"n_base": len(places), "first_word": low.count(b" ", 0, min(places)), "last_word": low.count(b" ", 0, max(places))}
        miss = 1.0
        for r, _, _ in found:
            miss *= 1 - r.score
        if base:
            miss = min(miss, 0.05)
        out |= {"base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {r.label for r, _, _ in found})), "score": 1 - miss}
        out["detections"] = [{"label": r.label, "priority": r.priority, "start": low.count(b" ", 0, a), "end": low.count(b" ", 0, b)} for r, a, b in found]
        return out

    def detect(self, low: bytes) -> list[tuple[Rule, int, int]]:
        has = {k for _, k in self.prefilter.iter(low.decode("latin-1"))}  # byte by byte: all keywords are ASCII
        if not has:
            return []
        hits = []
        for groups, some in self.by_keywords.items():
            if not any(has.isdisjoint(g) for g in groups):
                hits += [(r, m.start(), m.end()) for r in some for m in r.pattern.finditer(low)]
        hits.sort(key=lambda h: (-h[0].priority, h[1] - h[2], h[1], h[0].label))
        return suppress(hits)


def suppress(hits: list[tuple[Rule, int, int]]) -> list[tuple[Rule, int, int]]:
    """Keeps hits in their order unless their interval lies inside one that is kept; n log n.

    Kept intervals that no other contains have ascending starts and ends, so one neighbour decides.
    """
    starts: list[int] = []
    ends: dict[int, int] = {}
    kept = []
    for r, a, b in hits:
        i = bisect_right(starts, a) - 1
        if i >= 0 and ends[starts[i]] >= b:
            continue
        kept.append((r, a, b))
        while i >= 0 and starts[i] == a:
            del ends[starts.pop(i)]
            i -= 1
        j = i + 1
        while j < len(starts) and ends[starts[j]] <= b:
            del ends[starts.pop(j)]
        insort(starts, a)
        ends[a] = b
    return sorted(kept, key=lambda h: (h[1], h[2]))


_SCHEMA = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, detections array<struct<label: string, priority: int, start: bigint, end: bigint>>"


def scan(docs: DataFrame, text_col: str = "text", phrases: dict[str, str] | None = None) -> DataFrame:
    """docs without text_col, plus the columns of _SCHEMA; a column of docs with such a name is replaced.

    A null or empty text has no words and no labels. Each row is scanned, repeated ones too, and whole.
    Word places count from 0; a detection's end is the place after its last word.
    """

    @F.pandas_udf(_SCHEMA)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(phrases)
        for s in batches:
            rows = pd.DataFrame([scanner.scan(t) for t in s], columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])
            yield rows.astype({"first_word": "Int64", "last_word": "Int64"})

    made = [x.split()[0] for x in _SCHEMA.split("array")[0].split(", ")]
    m = fresh(docs.columns, "_scan")
    rest = [c for c in docs.columns if c != text_col and c.lower() not in made]
    return frugal(docs).withColumn(m, scanned.asNondeterministic()(F.col(text_col))).select(*rest, f"{m}.*")
