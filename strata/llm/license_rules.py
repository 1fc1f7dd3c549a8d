"""Signature rules of the licence scan.

Patterns match normalised text: lower-case words, one space between them, no
punctuation ("Apache License, Version 2.0" is "apache license version 2 0").
A rule is (label, priority, weight, pattern, keywords); it is only tried on
texts that hold one of its keywords as a word. Higher priority wins where one
detection contains another.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    weight: float
    pattern: re.Pattern
    keywords: frozenset[str]


#: Named licences: label, name pattern, SPDX id as words, path words of its
#: well-known page, and a keyword that any form of the name holds.
NAMED = [
    ("apache-2.0", r"apache (?:software )?license(?: version)? 2(?: 0)?", "apache 2 0", "licenses license 2 0", "apache"),
    ("apache-1.1", r"apache (?:software )?license(?: version)? 1 1", "apache 1 1", "licenses license 1 1", "apache"),
    ("apache-1.0", r"apache (?:software )?license(?: version)? 1 0", "apache 1 0", "licenses license 1 0", "apache"),
    ("gpl-3.0", r"gnu (?:general public license|gpl)(?: version| v)? ?3(?: 0)?", "gpl 3 0", "licenses gpl 3 0", "gnu gpl"),
    ("gpl-2.0", r"gnu (?:general public license|gpl)(?: version| v)? ?2(?: 0)?", "gpl 2 0", "licenses gpl 2 0", "gnu gpl"),
    ("gpl-1.0", r"gnu (?:general public license|gpl)(?: version| v)? ?1(?: 0)?", "gpl 1 0", "licenses gpl 1 0", "gnu gpl"),
    ("lgpl-3.0", r"gnu (?:lesser general public license|lgpl)(?: version| v)? ?3(?: 0)?", "lgpl 3 0", "licenses lgpl 3 0", "gnu lgpl"),
    ("lgpl-2.1", r"gnu (?:lesser general public license|lgpl)(?: version| v)? ?2 1", "lgpl 2 1", "licenses lgpl 2 1", "gnu lgpl"),
    ("lgpl-2.0", r"gnu (?:library general public license|lgpl)(?: version| v)? ?2(?: 0)?", "lgpl 2 0", "licenses lgpl 2 0", "gnu lgpl"),
    ("agpl-3.0", r"(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?", "agpl 3 0", "licenses agpl 3 0", "affero agpl"),
    ("gfdl-1.3", r"gnu free documentation license(?: version)? 1 3", "gfdl 1 3", "licenses fdl 1 3", "gnu gfdl"),
    ("gfdl-1.2", r"gnu free documentation license(?: version)? 1 2", "gfdl 1 2", "licenses fdl 1 2", "gnu gfdl"),
    ("mit", r"(?:the )?(?:mit|expat) licen[sc]e", "mit", "licenses mit", "mit expat"),
    ("mit-0", r"mit no attribution(?: licen[sc]e)?", "mit 0", "licenses mit 0", "mit"),
    ("bsd-2-clause", r"(?:2 clause|simplified|freebsd) bsd licen[sc]e", "bsd 2 clause", "licenses bsd 2 clause", "bsd"),
    ("bsd-3-clause", r"(?:3 clause|modified|new|revised) bsd licen[sc]e", "bsd 3 clause", "licenses bsd 3 clause", "bsd"),
    ("bsd-4-clause", r"(?:4 clause|original) bsd licen[sc]e", "bsd 4 clause", "licenses bsd 4 clause", "bsd"),
    ("0bsd", r"(?:zero clause|0 clause) bsd(?: licen[sc]e)?", "0bsd", "licenses 0bsd", "bsd 0bsd"),
    ("isc", r"isc licen[sc]e", "isc", "licenses isc", "isc"),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", "licenses zlib", "zlib"),
    ("mpl-2.0", r"mozilla public license(?: version| v)? ?2(?: 0)?", "mpl 2 0", "mpl 2 0", "mozilla mpl"),
    ("mpl-1.1", r"mozilla public license(?: version| v)? ?1 1", "mpl 1 1", "mpl 1 1", "mozilla mpl"),
    ("epl-2.0", r"eclipse public license(?: version| v)? ?2(?: 0)?", "epl 2 0", "epl 2 0", "eclipse epl"),
    ("epl-1.0", r"eclipse public license(?: version| v)? ?1(?: 0)?", "epl 1 0", "epl v10", "eclipse epl"),
    ("cddl-1.0", r"common development and distribution license(?: version)?(?: 1 0)?", "cddl 1 0", "licenses cddl 1 0", "cddl development"),
    ("cpl-1.0", r"common public license(?: version)? 1 0", "cpl 1 0", "licenses cpl1 0", "cpl common"),
    ("eupl-1.2", r"european union public licen[sc]e(?: version| v)? ?1 2", "eupl 1 2", "licenses eupl 1 2", "eupl european"),
    ("eupl-1.1", r"european union public licen[sc]e(?: version| v)? ?1 1", "eupl 1 1", "licenses eupl 1 1", "eupl european"),
    ("artistic-2.0", r"artistic license(?: version)? 2(?: 0)?", "artistic 2 0", "licenses artistic 2 0", "artistic"),
    ("artistic-1.0", r"artistic license(?: version)? 1(?: 0)?", "artistic 1 0", "licenses artistic 1 0", "artistic"),
    ("bsl-1.0", r"boost software license(?: version)?(?: 1 0)?", "bsl 1 0", "license 1 0", "boost bsl"),
    ("busl-1.1", r"business source license(?: version)?(?: 1 1)?", "busl 1 1", "bsl11", "business busl"),
    ("unlicense", r"the unlicense", "unlicense", "unlicense org", "unlicense"),
    ("wtfpl", r"do what the f\w* you want to public license", "wtfpl", "wtfpl net", "want"),
    ("postgresql", r"postgresql licen[sc]e", "postgresql", "about licence", "postgresql"),
    ("psf-2.0", r"python software foundation license(?: version 2)?", "python 2 0", "licenses psf 2 0", "python"),
    ("ofl-1.1", r"sil open font license(?: version)?(?: 1 1)?", "ofl 1 1", "scripts sil org ofl", "sil ofl"),
    ("odbl-1.0", r"open database license(?: v1 0| 1 0)?", "odbl 1 0", "licenses odbl", "odbl database"),
    ("odc-by-1.0", r"open data commons attribution license(?: v1 0| 1 0)?", "odc by 1 0", "licenses by 1 0", "odc commons"),
    ("pddl-1.0", r"public domain dedication and license(?: v1 0| 1 0)?", "pddl 1 0", "licenses pddl", "pddl domain"),
    ("ncsa", r"university of illinois ncsa open source license", "ncsa", "licenses ncsa", "ncsa"),
    ("ms-pl", r"microsoft public license", "ms pl", "licenses ms pl", "microsoft"),
    ("ms-rl", r"microsoft reciprocal license", "ms rl", "licenses ms rl", "microsoft"),
    ("upl-1.0", r"universal permissive license(?: version)?(?: 1 0)?", "upl 1 0", "licenses upl", "upl universal"),
    ("vim", r"vim license", "vim", "licenses vim", "vim"),
    ("ruby", r"ruby license", "ruby", "about license txt", "ruby"),
    ("php-3.01", r"php license(?: version)? 3 0\d", "php 3 01", "license 3 01", "php"),
    ("openssl", r"openssl license", "openssl", "source license", "openssl"),
    ("sspl-1.0", r"server side public license(?: version)?(?: 1)?", "sspl 1 0", "licensing server side public license", "sspl server"),
    ("elastic-2.0", r"elastic license(?: version)? 2 0", "elastic 2 0", "licensing elastic license", "elastic"),
    ("json", r"json license", "json", "license html", "json"),
    ("beerware", r"beer ?ware license", "beerware", "wiki beerware", "beer beerware"),
    ("cecill-2.1", r"cecill(?: free software license agreement)?(?: version)? 2 1", "cecill 2 1", "licences licence cecill v2 1", "cecill"),
    ("afl-3.0", r"academic free license(?: version)? 3 0", "afl 3 0", "licenses afl 3 0", "afl academic"),
    ("osl-3.0", r"open software license(?: version)? 3 0", "osl 3 0", "licenses osl 3 0", "osl software"),
    ("ecl-2.0", r"educational community license(?: version)? 2 0", "ecl 2 0", "licenses ecl 2 0", "ecl educational"),
    ("ipl-1.0", r"ibm public license(?: version)? 1 0", "ipl 1 0", "licenses ipl 1 0", "ibm ipl"),
    ("lppl-1.3c", r"latex project public license(?: version)?(?: 1 3c?)?", "lppl 1 3c", "lppl lppl 1 3c", "latex lppl"),
]

#: Page words that begin with the site's own name, not with a path.
SITES = ("unlicense org", "wtfpl net")

#: Creative Commons: label, elements as in the short name, and as in the full one.
CREATIVE = [
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s?"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
]

#: Passages of licence texts and notices: label, priority, weight, pattern, keywords.
PASSAGES = [
    ("mit", 5, 0.95, r"permission is hereby granted free of charge to any person obtaining a copy of this software", "permission"),
    ("mit", 4, 0.8, r"the above copyright notice and this permission notice shall be included in all copies", "permission"),
    ("isc", 6, 0.95, r"permission to use copy modify and or distribute this software for any purpose with or without fee", "permission"),
    ("bsd", 4, 0.8, r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd-3-clause", 5, 0.9, r"neither the name of (?:\w+ ){1,12}nor the names of its contributors may be used to endorse", "endorse"),
    ("bsd-4-clause", 6, 0.9, r"all advertising materials mentioning features or use of this software must display", "advertising"),
    ("bsd", 3, 0.7, r"redistributions of source code must retain the above copyright notice", "redistributions"),
    ("bsd", 3, 0.7, r"redistributions in binary form must reproduce the above copyright notice", "redistributions"),
    ("apache-2.0", 5, 0.95, r"licensed under the apache license version 2 0 the license you may not use this file", "apache"),
    ("apache-2.0", 4, 0.8, r"unless required by applicable law or agreed to in writing software distributed under the license", "distributed"),
    ("gpl", 4, 0.8, r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu"),
    ("gpl-2.0-or-later", 6, 0.9, r"gnu general public license (?:\w+ ){0,12}either version 2 of the license or at your option any later version", "gnu"),
    ("gpl-3.0-or-later", 6, 0.9, r"gnu general public license (?:\w+ ){0,12}either version 3 of the license or at your option any later version", "gnu"),
    ("lgpl", 5, 0.85, r"under the terms of the gnu lesser general public license", "lesser"),
    ("agpl-3.0", 6, 0.9, r"under the terms of the gnu affero general public license", "affero"),
    ("gpl", 2, 0.5, r"gnu general public license", "gnu"),
    ("lgpl", 3, 0.6, r"lesser general public license", "lesser"),
    ("lgpl", 3, 0.6, r"library general public license", "library"),
    ("agpl", 3, 0.6, r"affero general public license", "affero"),
    ("mpl-2.0", 5, 0.95, r"this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("mpl", 2, 0.5, r"mozilla public license", "mozilla"),
    ("epl", 2, 0.5, r"eclipse public license", "eclipse"),
    ("apache", 2, 0.5, r"apache (?:software )?license", "apache"),
    ("bsd", 2, 0.5, r"bsd (?:style )?licen[sc]e", "bsd"),
    ("zlib", 5, 0.9, r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty"),
    ("zlib", 4, 0.8, r"altered source versions must be plainly marked as such", "altered"),
    ("unlicense", 5, 0.95, r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", 3, 0.7, r"(?:released|placed|dedicated|put) (?:in|into|to) the public domain", "domain"),
    ("public-domain", 3, 0.7, r"(?:this work|this file|this text|this software) is in the public domain", "domain"),
    ("public-domain", 3, 0.7, r"no (?:known )?copyright restrictions", "restrictions"),
    ("wtfpl", 5, 0.9, r"everyone is permitted to copy and distribute verbatim or modified copies of this license document", "verbatim"),
    ("bsl-1.0", 5, 0.9, r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "permission"),
    ("ofl-1.1", 4, 0.8, r"this font software is licensed under the sil open font license", "font"),
    ("artistic", 2, 0.5, r"the artistic license", "artistic"),
    ("proprietary", 4, 0.8, r"proprietary and confidential", "proprietary"),
    ("proprietary", 4, 0.8, r"confidential and proprietary", "proprietary"),
    ("proprietary", 4, 0.8, r"unauthorized (?:copying|reproduction|use|distribution) (?:\w+ ){0,8}(?:is )?(?:strictly )?prohibited", "unauthorized"),
    ("proprietary", 3, 0.7, r"may not be (?:reproduced|copied|redistributed|republished|rewritten)(?: \w+){0,10} without (?:\w+ ){0,4}permission", "permission"),
    ("proprietary", 3, 0.7, r"no part of this (?:publication|book|document|work|site) may be reproduced", "reproduced"),
    ("proprietary", 3, 0.6, r"for internal use only", "internal"),
    ("proprietary", 4, 0.8, r"this software is the (?:confidential )?(?:proprietary )?property of", "property"),
    ("proprietary", 4, 0.7, r"end user licen[sc]e agreement", "agreement"),
    ("reserved", 2, 0.6, r"all rights (?:are )?reserved", "reserved"),
    ("reserved", 2, 0.6, r"tous droits reserves|tous droits réservés", "droits"),
    ("reserved", 2, 0.6, r"alle rechte vorbehalten", "vorbehalten"),
    ("reserved", 2, 0.6, r"todos los derechos reservados", "derechos"),
    ("copyright-notice", 1, 0.4, r"copyright (?:c )?(?:19|20)\d\d", "copyright"),
    ("copyright-notice", 1, 0.3, r"copyright (?:holders?|owners?|notice)", "copyright"),
    ("non-commercial", 3, 0.7, r"(?:for )?non ?commercial (?:use|purposes?)(?: only)?", "commercial noncommercial"),
    ("research-only", 3, 0.7, r"for (?:academic )?research (?:use|purposes?) only", "research"),
    ("no-ai-training", 4, 0.8, r"(?:may not|must not|not) be used (?:to|for) train(?:ing)? (?:\w+ ){0,4}(?:ai|models?|machine learning)", "training train"),
    ("attribution-required", 2, 0.5, r"attribution (?:is )?required", "attribution"),
    ("cc", 2, 0.5, r"creative commons licen[sc]e", "creative"),
    ("cc", 2, 0.5, r"some rights reserved", "reserved"),
    ("free-use", 2, 0.5, r"free (?:for|to) (?:personal|private|commercial) use", "free"),
    ("licensed", 1, 0.3, r"licensed under (?:the )?(?:terms of )?(?:the )?(?:a )?\w+", "licensed"),
    ("licensed", 1, 0.3, r"see (?:the )?(?:file )?(?:licen[sc]e|copying)(?: txt| md)? (?:file )?for (?:details|more)", "license licence copying"),
    ("licensed", 1, 0.3, r"spdx license identifier \w+", "spdx"),
]

#: Short forms of everyday notices and file heads: label, priority, weight,
#: pattern, keywords. A version always belongs to them, as the bare names are
#: common words or say too little.
EVERYDAY = [
    ("gpl-3.0-or-later", 6, 0.8, r"(?:gpl ?v?|gpl version )3(?: 0)? (?:or later|or any later version)", "gpl gplv3 gpl3"),
    ("gpl-2.0-or-later", 6, 0.8, r"(?:gpl ?v?|gpl version )2(?: 0)? (?:or later|or any later version)", "gpl gplv2 gpl2"),
    ("gpl-3.0", 4, 0.7, r"(?:gpl ?v?|gpl version )3(?: 0)?(?: only)?(?: licen[sc]ed?)?", "gpl gplv3 gpl3"),
    ("gpl-2.0", 4, 0.7, r"(?:gpl ?v?|gpl version )2(?: 0)?(?: only)?(?: licen[sc]ed?)?", "gpl gplv2 gpl2"),
    ("gpl-3.0", 5, 0.7, r"general public licen[sc]e (?:v ?|version )?3(?: 0)?", "general"),
    ("gpl-2.0", 5, 0.7, r"general public licen[sc]e (?:v ?|version )?2(?: 0)?", "general"),
    ("gpl-3.0", 5, 0.7, r"version 3 of the (?:gnu )?(?:gpl|general public licen[sc]e)", "gpl general"),
    ("gpl-2.0", 5, 0.7, r"version 2 of the (?:gnu )?(?:gpl|general public licen[sc]e)", "gpl general"),
    ("lgpl-3.0", 4, 0.7, r"(?:lgpl ?v?|lgpl version )3(?: 0)?(?: only| or later)?", "lgpl lgplv3 lgpl3"),
    ("lgpl-2.1", 5, 0.7, r"(?:lgpl ?v?|lgpl version )2 1(?: only| or later)?", "lgpl lgplv2 lgpl2"),
    ("lgpl-2.0", 4, 0.6, r"(?:lgpl ?v?|lgpl version )2(?: 0)?(?: only| or later)?", "lgpl lgplv2 lgpl2"),
    ("agpl-3.0", 4, 0.7, r"(?:agpl ?v?|agpl version )3(?: 0)?(?: only| or later)?", "agpl agplv3 agpl3"),
    ("apache-2.0", 4, 0.7, r"(?:apache ?v?|apache version )2(?: 0)?(?: (?:software )?licen[sc]ed?)?", "apache apachev2 apache2"),
    ("apache-2.0", 5, 0.7, r"apache (?:software )?licen[sc]e v ?2(?: 0)?", "apache"),
    ("apache-2.0", 5, 0.7, r"version 2(?: 0)? of the apache licen[sc]e", "apache"),
    ("apache-2.0", 4, 0.6, r"asl 2 0", "asl"),
    ("bsd-2-clause", 5, 0.7, r"(?:new |modified |simplified )?bsd (?:2|two) clause(?: licen[sc]ed?)?", "bsd"),
    ("bsd-3-clause", 5, 0.7, r"(?:new |modified |revised )?bsd (?:3|three) clause(?: licen[sc]ed?)?", "bsd"),
    ("bsd-4-clause", 5, 0.7, r"(?:original )?bsd (?:4|four) clause(?: licen[sc]ed?)?", "bsd"),
    ("bsd-2-clause", 5, 0.7, r"(?:2|two) clause bsd(?: style)?(?: licen[sc]ed?)?", "bsd"),
    ("bsd-3-clause", 5, 0.7, r"(?:3|three) clause bsd(?: style)?(?: licen[sc]ed?)?", "bsd"),
    ("bsd-4-clause", 5, 0.7, r"(?:4|four) clause bsd(?: style)?(?: licen[sc]ed?)?", "bsd"),
    ("bsd", 3, 0.5, r"bsd licen[sc]ed", "bsd"),
    ("mit", 5, 0.7, r"mit (?:expat )?licen[sc]ed", "mit"),
    ("mit", 5, 0.7, r"(?:licen[sc]ed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?mit", "mit"),
    ("isc", 5, 0.7, r"isc licen[sc]ed", "isc"),
    ("mpl-2.0", 4, 0.7, r"(?:mpl ?v?|mpl version )2(?: 0)?(?: licen[sc]ed?)?", "mpl mplv2 mpl2"),
    ("mpl-1.1", 4, 0.7, r"(?:mpl ?v?|mpl version )1 1(?: licen[sc]ed?)?", "mpl mplv1 mpl1"),
    ("epl-2.0", 4, 0.7, r"(?:epl ?v?|epl version )2(?: 0)?(?: licen[sc]ed?)?", "epl eplv2 epl2"),
    ("epl-1.0", 4, 0.7, r"(?:epl ?v?|epl version )1(?: 0)?(?: licen[sc]ed?)?", "epl eplv1 epl1"),
    ("cddl-1.0", 4, 0.6, r"cddl (?:v ?|version )?1 [01]", "cddl"),
    ("eupl-1.2", 4, 0.7, r"eupl (?:v ?|version )?1 2", "eupl"),
    ("eupl-1.1", 4, 0.7, r"eupl (?:v ?|version )?1 1", "eupl"),
    ("ofl-1.1", 4, 0.7, r"(?:sil )?ofl (?:v ?|version )?1 1", "ofl"),
    ("bsl-1.0", 4, 0.6, r"bsl 1 0", "bsl"),
    ("busl-1.1", 4, 0.6, r"busl 1 1", "busl"),
    ("sspl-1.0", 4, 0.6, r"sspl(?:v1| v1| 1 0)", "sspl sspl1 ssplv1"),
    ("odbl-1.0", 4, 0.6, r"odbl (?:v ?)?1 0", "odbl"),
]


def rules() -> list[Rule]:
    """All rules, highest priority first."""
    out = []

    def add(label, priority, weight, pattern, keywords):
        out.append(Rule(label, priority, weight, re.compile(rf"(?<![^ ]){pattern}(?![^ ])"),
                        frozenset(keywords.split())))

    for label, name, spdx, page, key in NAMED:
        add(label, 7, 0.9, rf"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{name}", key)
        add(label, 5, 0.7, name, key)
        add(label, 8, 0.95, rf"spdx license identifier {spdx}(?: only| or later)?", "spdx")
        add(label, 4, 0.7, page if page in SITES else rf"(?:org|com|net|fr) (?:\w+ ){{0,3}}{page}", page.split()[0])
    for label, short, full in CREATIVE:
        add(label, 6, 0.8, rf"cc {short}(?: [1-4] \d)?", "cc")
        add(label, 7, 0.9, rf"licensed under (?:a |the )?cc {short}(?: [1-4] \d)?", "cc")
        add(label, 6, 0.8, rf"creative commons {full}(?: [1-4] \d)?(?: international| unported| generic)?", "creative")
        add(label, 6, 0.8, rf"creativecommons org licenses {short}(?: [1-4] \d)?", "creativecommons")
        add(label, 8, 0.95, rf"spdx license identifier cc {short}(?: [1-4] \d)?", "spdx")
    add("cc0-1.0", 6, 0.9, r"cc0(?: 1 0)?(?: universal)?", "cc0")
    add("cc0-1.0", 6, 0.9, r"creativecommons org publicdomain zero 1 0", "publicdomain")
    for p in (*PASSAGES, *EVERYDAY):
        add(*p)
    return sorted(out, key=lambda r: -r.priority)
