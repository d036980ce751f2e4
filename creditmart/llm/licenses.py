"""License statements found by ordered signature rules.

A rule is a regex with a label, a weight and keywords; only rules whose keyword stands in the text
are tried, found for all rules in one Aho-Corasick pass. Regexes run over the text's words (ASCII letters
and digits in lower case and all other non-ASCII characters; anything else separates), joined by
blanks, so layout and punctuation do not matter. Rules are ordered by priority. Of overlapping
detections one that lies within a detection of a better or equal priority is suppressed, equal
intervals by the earlier rule; those that overlap in part stay both.

Three base phrases are kept apart: their places and labels are reported whatever the rules say.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import free_name, prepare, utf8

# The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

FULL_TEXT, HEADER, TAG, TITLE, MENTION = range(5)  # priorities, best first
WEIGHT = {FULL_TEXT: 1.0, HEADER: 0.95, TITLE: 0.85, TAG: 0.9, MENTION: 0.6}


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keyword: str  # a plain string that every match contains
    priority: int


VERSION = r"(?: v| version| ver|)"

# Sentences of license texts and headers: label, keyword, pattern. Hand-written.
SENTENCES = (
    ("mit", "free of charge", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "the software is provided", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", "substantial portions", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-0", "no attribution", r"mit no attribution(?: license)?"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0bsd", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", r"neither the name of (?:the )?\w+(?: \w+){0,8} nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2.0", "apache license", r"licensed under the apache license" + VERSION + r" 2(?: 0)?"),
    ("apache-2.0", "except in compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache org", r"(?:http|https) www apache org licenses license 2 0"),
    ("gpl", "free software you can", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "free software you can", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "affero", r"under the terms of the gnu affero general public license"),
    ("gpl", "gnu org", r"(?:http|https) www gnu org licenses(?: gpl)?"),
    ("gpl", "without any warranty", r"distributed in the hope that it will be useful but without any warranty"),
    ("mpl", "mozilla public", r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "mozilla org", r"(?:http|https) mozilla org mpl"),
    ("epl", "eclipse public", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the", r"do what the fuck you want to(?: public license)?"),
    ("zlib", "origin of this software", r"the origin of this software must not be misrepresented"),
    ("boost", "boost software", r"boost software license" + VERSION + r" 1 0"),
    ("artistic", "artistic license", r"(?:the )?artistic license" + VERSION + r"(?: [12] 0)?"),
    ("cc0", "dedicated the work", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"proprietary and confidential"),
    ("proprietary", "unauthorized copying", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("non-commercial", "non commercial", r"for (?:personal and )?non commercial (?:use|purposes) only"),
    ("ofl", "open font", r"this font software is licensed under the sil open font license" + VERSION + r" 1 [01]"),
    ("psf", "python software", r"python software foundation license" + VERSION + r"(?: 2)?"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("php", "php license", r"(?:the )?php license" + VERSION + r"(?: 3 0[01]?)?"),
    ("cddl", "common development", r"common development and distribution license"),
    ("ms-pl", "microsoft public", r"microsoft public license"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal license"),
    ("ncsa", "illinois", r"university of illinois (?:ncsa )?open source license"),
    ("postgresql", "postgresql license", r"postgresql license"),
    ("curl", "curl license", r"curl license"),
    ("ogl", "open government", r"open government licen[cs]e" + VERSION + r"(?: [123] 0)?"),
)

# More sentences: version clauses of headers and sentences of full texts. Label, keyword, pattern.
MORE_SENTENCES = (
    ("gpl-2.0", "version 2 of the license", r"gnu general public license as published by the free software foundation either version 2 of the license(?: or at your option any later version)?"),
    ("gpl-2.0", "version 2 as published", r"gnu general public license version 2 as published by the free software foundation"),
    ("gpl-2.0", "version 2 of the license", r"gnu general public license as published by the free software foundation version 2 of the license"),
    ("gpl-3.0", "version 3 of the license", r"gnu general public license as published by the free software foundation either version 3 of the license(?: or at your option any later version)?"),
    ("gpl-2.0", "general public license version 2", r"gnu general public license version 2 june 1991"),
    ("gpl-3.0", "general public license version 3", r"gnu general public license version 3 29 june 2007"),
    ("lgpl-2.0", "version 2 of the license", r"gnu (?:lesser|library) general public license as published by the free software foundation either version 2 of the license(?: or at your option any later version)?"),
    ("lgpl-2.1", "version 2 1 of the license", r"gnu lesser general public license as published by the free software foundation either version 2 1 of the license(?: or at your option any later version)?"),
    ("lgpl-3.0", "version 3 of the license", r"gnu lesser general public license as published by the free software foundation either version 3 of the license(?: or at your option any later version)?"),
    ("agpl-3.0", "version 3 of the license", r"gnu affero general public license as published by the free software foundation either version 3 of the license(?: or at your option any later version)?"),
    ("gfdl", "free documentation license", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", "apache license", r"apache license version 2 0 january 2004"),
    ("apache-2.0", "asf under one", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", "express or implied", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistributions of source", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "use of this source code", r"use of this source code is governed by a bsd style license"),
    ("mit", "use of this source code", r"use of this source code is governed by an mit style license"),
    ("isc", "disclaims all warranties", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("zlib", "express or implied warranty", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost", "machine executable", r"unless such copies or derivative works are solely in the form of machine executable object code"),
    ("mpl-1.1", "contents of this file", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2.0", "a copy of the mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("cddl", "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cc0", "waived all copyright", r"waived all copyright and related or neighboring rights"),
    ("unlicense", "public domain", r"in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain"),
    ("json", "used for good", r"the software shall be used for good not evil"),
    ("beerware", "buy me a beer", r"you can buy me a beer in return"),
)

# Real SPDX identifiers; each is a rule for its SPDX tag.
SPDX = """
0BSD AAL AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-1.0-only AGPL-1.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later
Apache-1.0 Apache-1.1 Apache-2.0 APSL-1.0 APSL-1.1 APSL-1.2 APSL-2.0 Artistic-1.0 Artistic-1.0-cl8 Artistic-1.0-Perl Artistic-2.0
Beerware BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-2-Clause-Views BSD-3-Clause BSD-3-Clause-Attribution
BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-4-Clause BSD-4-Clause-UC BSD-Source-Code BSL-1.0 BUSL-1.1 bzip2-1.0.6 CAL-1.0 CATOSL-1.1
CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0
CC-BY-ND-1.0 CC-BY-ND-2.0 CC-BY-ND-2.5 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-NC-1.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0 CC-BY-NC-4.0
CC-BY-NC-SA-1.0 CC-BY-NC-SA-2.0 CC-BY-NC-SA-2.5 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0
CC-BY-NC-ND-1.0 CC-BY-NC-ND-2.0 CC-BY-NC-ND-2.5 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-PDDC CC0-1.0 CDDL-1.0 CDDL-1.1
CDLA-Permissive-1.0 CDLA-Permissive-2.0 CDLA-Sharing-1.0 CECILL-1.0 CECILL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C
CERN-OHL-1.1 CERN-OHL-1.2 CERN-OHL-P-2.0 CERN-OHL-S-2.0 CERN-OHL-W-2.0 ClArtistic CPAL-1.0 CPL-1.0 curl ECL-1.0 ECL-2.0 EFL-1.0 EFL-2.0
Elastic-2.0 EPL-1.0 EPL-2.0 EUDatagrid EUPL-1.0 EUPL-1.1 EUPL-1.2 Fair FSFAP FSFUL FTL GFDL-1.1 GFDL-1.1-only GFDL-1.1-or-later
GFDL-1.2 GFDL-1.2-only GFDL-1.2-or-later GFDL-1.3 GFDL-1.3-only GFDL-1.3-or-later GPL-1.0 GPL-1.0-only GPL-1.0-or-later
GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ICU IJG Intel IPL-1.0 ISC JSON
LAL-1.2 LAL-1.3 LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later
Libpng libpng-2.0 libtiff LPL-1.0 LPL-1.02 LPPL-1.0 LPPL-1.1 LPPL-1.2 LPPL-1.3a LPPL-1.3c MIT MIT-0 MIT-advertising MIT-CMU MIT-enna MIT-feh
MIT-Modern-Variant MirOS MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-1.0 MulanPSL-2.0 NASA-1.3 NCSA
Nokia NPL-1.0 NPL-1.1 NPOSL-3.0 NTP ODbL-1.0 ODC-By-1.0 OFL-1.0 OFL-1.1 OGL-UK-1.0 OGL-UK-2.0 OGL-UK-3.0 OpenSSL OSL-1.0 OSL-1.1 OSL-2.0
OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 RPL-1.1 RPL-1.5 Ruby SGI-B-2.0 SISSL Sleepycat SPL-1.0 SSPL-1.0
TCL Unicode-DFS-2015 Unicode-DFS-2016 Unicode-3.0 Unlicense UPL-1.0 Vim W3C Watcom-1.0 WTFPL X11 XFree86-1.1 Zend-2.0 Zlib zlib-acknowledgement
ZPL-1.1 ZPL-2.0 ZPL-2.1
""".split()

# Names, short forms and addresses, one to a line: label, then words that stand in every match, then the rest after "|".
# V stands for an optional version word and a blank, L for an optional "or later" or "only".
TITLES = r"""
mit: mit license
mit: mit licence
mit: expat license
mit: opensource org licenses mit
x11: x11 license
isc: isc license
isc: opensource org licenses isc
0bsd: zero clause bsd|(?: license)?
0bsd: bsd zero clause|(?: license)?
0bsd: 0bsd
bsd: bsd license
bsd: bsd licence
bsd: bsd style license
bsd-2-clause: bsd 2 clause|(?: licen[cs]e)?
bsd-2-clause: 2 clause bsd|(?: licen[cs]e)?
bsd-2-clause: two clause bsd|(?: licen[cs]e)?
bsd-2-clause: simplified bsd|(?: licen[cs]e)?
bsd-2-clause: freebsd license
bsd-2-clause: opensource org licenses bsd 2 clause
bsd-3-clause: bsd 3 clause|(?: licen[cs]e)?
bsd-3-clause: 3 clause bsd|(?: licen[cs]e)?
bsd-3-clause: three clause bsd|(?: licen[cs]e)?
bsd-3-clause: new bsd license
bsd-3-clause: modified bsd license
bsd-3-clause: revised bsd license
bsd-3-clause: opensource org licenses bsd 3 clause
bsd-4-clause: bsd 4 clause|(?: licen[cs]e)?
bsd-4-clause: 4 clause bsd|(?: licen[cs]e)?
bsd-4-clause: original bsd license
apache-1.0: apache license|V1 0
apache-1.0: apache software license|V1 0
apache-1.1: apache license|V1 1
apache-1.1: apache software license|V1 1
apache-2.0: apache license|V2(?: 0)?
apache-2.0: apache software license|V2(?: 0)?
apache-2.0: apache public license|V2(?: 0)?
apache-2.0: apache 2 0|(?: licen[cs]e)?
apache-2.0: apache 2 license
apache-2.0: apache v2|(?: 0)?(?: licen[cs]e)?
apache-2.0: apache2 license
apache-2.0: apache2 0
apache-2.0: asl 2 0
apache-2.0: alv2
apache-2.0: opensource org licenses apache 2 0
gpl-1.0: gnu general public license|V1(?: 0)?L
gpl-1.0: gpl|V1(?: 0)?L
gpl-1.0: gplv1|(?: 0)?L
gpl-2.0: gnu general public license|V2(?: 0)?L
gpl-2.0: gnu gpl|V2(?: 0)?L
gpl-2.0: gnu gplv2|(?: 0)?L
gpl-2.0: gpl|V2(?: 0)?L
gpl-2.0: gplv2|(?: 0)?L
gpl-2.0: gpl2|(?: 0)?L
gpl-2.0: gnu org licenses old licenses gpl 2 0|(?: en)?(?: (?:html|txt))?
gpl-2.0: gnu org licenses gpl 2 0|(?: en)?(?: (?:html|txt))?
gpl-2.0: opensource org licenses gpl 2 0
gpl-3.0: gnu general public license|V3(?: 0)?L
gpl-3.0: gnu gpl|V3(?: 0)?L
gpl-3.0: gnu gplv3|(?: 0)?L
gpl-3.0: gpl|V3(?: 0)?L
gpl-3.0: gplv3|(?: 0)?L
gpl-3.0: gpl3|(?: 0)?L
gpl-3.0: gnu org licenses gpl 3 0|(?: en)?(?: (?:html|txt))?
gpl-3.0: opensource org licenses gpl 3 0
lgpl-2.0: gnu library general public license|V2(?: 0)?L
lgpl-2.0: gnu lesser general public license|V2(?: 0)?L
lgpl-2.0: lgpl|V2(?: 0)?L
lgpl-2.0: lgplv2|(?: 0)?L
lgpl-2.0: lgpl2|(?: 0)?L
lgpl-2.1: gnu lesser general public license|V2 1L
lgpl-2.1: gnu lgpl|V2 1L
lgpl-2.1: gnu lgplv2 1|L
lgpl-2.1: lgpl|V2 1L
lgpl-2.1: lgplv2 1|L
lgpl-2.1: lgpl2 1|L
lgpl-2.1: gnu org licenses old licenses lgpl 2 1|(?: en)?(?: (?:html|txt))?
lgpl-2.1: opensource org licenses lgpl 2 1
lgpl-3.0: gnu lesser general public license|V3(?: 0)?L
lgpl-3.0: gnu lgpl|V3(?: 0)?L
lgpl-3.0: gnu lgplv3|(?: 0)?L
lgpl-3.0: lgpl|V3(?: 0)?L
lgpl-3.0: lgplv3|(?: 0)?L
lgpl-3.0: lgpl3|(?: 0)?L
lgpl-3.0: gnu org licenses lgpl 3 0|(?: en)?(?: (?:html|txt))?
agpl-1.0: affero general public license|V1(?: 0)?L
agpl-3.0: gnu affero general public license|V3(?: 0)?L
agpl-3.0: gnu agpl|V3(?: 0)?L
agpl-3.0: gnu agplv3|(?: 0)?L
agpl-3.0: agpl|V3(?: 0)?L
agpl-3.0: agplv3|(?: 0)?L
agpl-3.0: agpl3|(?: 0)?L
agpl-3.0: gnu org licenses agpl 3 0|(?: en)?(?: (?:html|txt))?
gfdl-1.1: gnu free documentation license|V1 1L
gfdl-1.2: gnu free documentation license|V1 2L
gfdl-1.3: gnu free documentation license|V1 3L
gfdl-1.1: gfdl|V1 1L
gfdl-1.2: gfdl|V1 2L
gfdl-1.3: gfdl|V1 3L
gfdl: gnu org licenses fdl|(?: 1 [123])?
mpl-1.0: mozilla public license|V1 0
mpl-1.1: mozilla public license|V1 1
mpl-2.0: mozilla public license|V2(?: 0)?
mpl-1.1: mpl|V1 1
mpl-2.0: mpl|V2 0
mpl-2.0: mplv2|(?: 0)?
mpl-2.0: mozilla org mpl 2 0
epl-1.0: eclipse public license|V1(?: 0)?
epl-1.0: epl|V1 0
epl-2.0: eclipse public license|V2(?: 0)?
epl-2.0: epl|V2 0
epl-1.0: eclipse org legal epl v10
epl-2.0: eclipse org legal epl 2 0
eupl-1.0: european union public licence|V1 0
eupl-1.1: european union public licence|V1 1
eupl-1.2: european union public licence|V1 2
eupl-1.0: eupl|V1 0
eupl-1.1: eupl|V1 1
eupl-1.2: eupl|V1 2
osl-1.0: open software license|V1 0
osl-2.0: open software license|V2 0
osl-2.1: open software license|V2 1
osl-3.0: open software license|V3 0
osl-3.0: osl|V3 0
afl-1.2: academic free license|V1 2
afl-2.0: academic free license|V2 0
afl-2.1: academic free license|V2 1
afl-3.0: academic free license|V3 0
afl-3.0: afl|V3 0
cecill-1.0: cecill|V1 0
cecill-1.1: cecill|V1 1
cecill-2.0: cecill|V2 0
cecill-2.1: cecill|V2 1
cecill-b: cecill b
cecill-c: cecill c
odc-by-1.0: open data commons attribution license|V1 0
odc-by-1.0: odc by|V1 0
odbl-1.0: open database license|V1 0
odbl-1.0: odbl|V1 0
odbl: opendatacommons org licenses odbl
bsl-1.0: business source license|V1 0
bsl-1.1: business source license|V1 1
bsl-1.1: busl|V1 1
cddl-1.0: common development and distribution license|(?: cddl)?V1 0
cddl-1.1: common development and distribution license|(?: cddl)?V1 1
cddl-1.0: cddl|V1 0
cddl-1.1: cddl|V1 1
zlib: zlib license
zlib: zlib libpng license
boost: boost license
boost: bsl 1 0
boost: boost org license 1 0|(?: txt)?
unlicense: the unlicense
unlicense: unlicense org
cc0: cc0 1 0 universal
cc0: cc0
cc0: creative commons zero
cc0: creativecommons org publicdomain zero 1 0
public-domain: creativecommons org publicdomain mark 1 0
wtfpl: wtfpl
beerware: beerware license
beerware: beer ware license
ofl-1.1: sil open font license|V1 1
ofl-1.0: sil open font license|V1 0
ofl: scripts sil org ofl
artistic-1.0: artistic license|V1 0
artistic-2.0: artistic license|V2 0
psf: psf license
psf: psfl
ms-pl: ms pl
ms-rl: ms rl
ecl-2.0: educational community license|V2 0
upl-1.0: universal permissive license|V1 0
cpl-1.0: common public license|V1 0
ipl-1.0: ibm public license|V1 0
qpl-1.0: q public license|V1 0
sspl-1.0: server side public license|(?:V1)?
elastic-2.0: elastic license|V2(?: 0)?
cpal-1.0: common public attribution license|(?:V1 0)?
lppl: latex project public license|(?:V1 (?:[012]|3[ac]?))?
lppl: lppl|(?:V1 (?:[012]|3[ac]?))?
vim: vim license
ruby: ruby license
zpl: zope public license|(?:V[12] [01])?
w3c: w3c software notice and license
w3c: w3c software license
openssl: openssl license
ncsa: ncsa license
tcl: tcl tk license
hpnd: historical permission notice and disclaimer
blueoak-1.0.0: blue oak model license|(?:V1 0 0)?
mulanpsl-2.0: mulan permissive software license|V2
"""
# Names without a version, in the same form.
MENTIONS = r"""
mit: or mit|(?<=2 0 or mit)
mit: and mit|(?<=2 0 and mit)
apache: apache license
apache: apache software license
apache: apache public license
gpl: gnu general public license
gpl: gnu gpl
gpl: gpl
lgpl: gnu lesser general public license
lgpl: gnu library general public license
lgpl: gnu lgpl
lgpl: lgpl
agpl: gnu affero general public license
agpl: gnu agpl
agpl: agpl
gfdl: gnu free documentation license
gfdl: gfdl
mpl: mozilla public license
mpl: mpl
epl: eclipse public license
epl: epl
eupl: european union public licen|[cs]e
eupl: eupl
osl: open software license
osl: osl
afl: academic free license
afl: afl
cecill: cecill
odc-by: open data commons attribution license
odc-by: odc by
odbl: open database license
odbl: odbl
bsl: business source license
bsl: busl
ofl: open font license
cddl: cddl
sspl: sspl
cc-by: creativecommons org licenses by
cc-by-sa: creativecommons org licenses by sa
cc-by-nd: creativecommons org licenses by nd
cc-by-nc: creativecommons org licenses by nc
cc-by-nc-sa: creativecommons org licenses by nc sa
cc-by-nc-nd: creativecommons org licenses by nc nd
unspecified: licensed under|(?: the)? [^ ]+ licen[cs]e
"""
# The six Creative Commons licenses: short and spoken name. Each has these versions.
CC = (
    ("by", "attribution"), ("by sa", "attribution share ?alike"), ("by nd", "attribution no ?deriv(?:ative)?s?"),
    ("by nc", "attribution non ?commercial"), ("by nc sa", "attribution non ?commercial share ?alike"),
    ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"))
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


# What the macros V and L stand for, and the words that may go before a name.
MACROS = {"V": r" (?:(?:version|ver|v) ?)?", "L": r"(?: (?:or|and) (?:any )?(?:later|newer)(?: versions?)?| only)?"}
LEAD = r"(?:(?:released|licensed|distributed) )?(?:under )?(?:the )?"
OTHER_LABELS = {"bsl-1.0": "boost", "busl-1.1": "bsl-1.1"}


def _listed(lines: str, priority: int, tail: str = "") -> list[Rule]:
    out = []
    for line in lines.strip().splitlines():
        label, _, form = line.partition(": ")
        head, _, rest = form.partition("|")
        rest = "".join(MACROS.get(c, c) for c in rest)
        out.append(Rule(label, LEAD + head + rest + tail, head, priority))
    return out


def _version(label: str, version: str) -> str:
    return f"{label}-{version.replace(' ', '.')}"


def rules() -> list[Rule]:
    """All rules, best priority first; within one in the order written."""
    out = [Rule(label, pattern, keyword, HEADER if keyword in ("apache license", "affero") or "copy" not in pattern else FULL_TEXT)
           for label, keyword, pattern in (*SENTENCES, *((x, k, LEAD + p) for x, k, p in MORE_SENTENCES))]
    for name in SPDX:
        words = b" ".join(words_of(name.encode())).decode()
        label = name.lower().removesuffix("-only").removesuffix("-or-later")
        out.append(Rule(OTHER_LABELS.get(label, label), f"spdx license identifier {words}", f"identifier {words}", TAG))
    out += _listed(TITLES, TITLE)
    for parts, name in CC:
        label = "cc-" + parts.replace(" ", "-")
        for version in CC_VERSIONS:
            out.append(Rule(_version(label, version), f"cc {parts} {version}", f"cc {parts} {version}", TITLE))
            out.append(Rule(_version(label, version), rf"creative commons {name} {version}", "creative commons", TITLE))
            out.append(Rule(_version(label, version), f"creativecommons org licenses {parts} {version}", f"creativecommons org licenses {parts}", TAG))
        out.append(Rule(label, f"cc {parts}", f"cc {parts}", MENTION))
        out.append(Rule(label, rf"creative commons {name}", "creative commons", MENTION))
    return sorted(out + _listed(MENTIONS, MENTION, "(?: licen[cs]e)?"), key=lambda r: r.priority)


class Scanner:
    """Compiled rules and the automaton of their keywords; built once per task."""

    def __init__(self, ordered: list[Rule]):
        import ahocorasick

        self.rules = [(r, re.compile(rf"(?<![^ ]){r.pattern}(?![^ ])")) for r in ordered]
        by_key: dict[str, list[int]] = {}
        for number, rule in enumerate(ordered):
            by_key.setdefault(rule.keyword, []).append(number)
        self.automaton = ahocorasick.Automaton()
        for key, numbers in by_key.items():
            self.automaton.add_word(key, numbers)
        self.automaton.make_automaton()
        self.base = [(re.compile(rf"(?<![^ ])(?={phrase}(?: |$))"), label) for phrase, label in BASE]

    def scan(self, words: list[str]):
        """(base places [(word, label)], detections [(first, end, label, weight)]) in words."""
        text = " ".join(words)
        tried = sorted({n for _, numbers in self.automaton.iter(text) for n in numbers})
        found = [
            (m.start(), m.end(), n) for n in tried for m in self.rules[n][1].finditer(text) if m.end() > m.start()]
        base = [(m.start(), label) for regex, label in self.base for m in regex.finditer(text)]
        kept = suppress([(a, b, self.rules[n][0].priority, n) for a, b, n in found])
        number = _word_numbers(text, [x for a, b, _, _ in kept for x in (a, b)] + [a for a, _ in base])
        return (
            sorted((number[a], label) for a, label in base),
            [(number[a], number[b] + 1, self.rules[n][0].label, WEIGHT[p]) for a, b, p, n in kept])


def _word_numbers(text: str, places: list[int]) -> dict[int, int]:
    """Number of the word that holds, or ends at, each place."""
    out, at, count = {}, 0, 0
    for place in sorted(set(places)):
        count += text.count(" ", at, place)
        at = place
        out[place] = count
    return out


def suppress(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Drop each (start, end, priority, rule) within another of better or equal priority.

    Of equal intervals and priorities the earlier rule stays. One sweep by start, longest first, sees
    whatever holds a detection before it, and keeps the farthest end so far of each priority.
    """
    farthest: dict[int, int] = {}
    out = []
    for start, end, priority, rule in sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3])):
        if any(e >= end for p, e in farthest.items() if p <= priority):
            continue
        out.append((start, end, priority, rule))
        farthest[priority] = max(end, farthest.get(priority, -1))
    return out


TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def scan(docs: DataFrame, ordered: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """Add n_words, base (places and labels), detections and score to every document.

    ``base`` lists (word, label) of each place of a base phrase, ``detections`` (first, end, label,
    weight) in words of what the rules found. ``score`` is 1 - the product of (1 - weight / 2) over
    base places and detections: 0 without any, higher with more and stronger ones. Null and empty
    texts have no words and score 0; repeated rows come out alike; other columns stay, save that
    columns named like results are replaced.
    """
    spark = prepare(docs.sparkSession)
    ordered = rules() if ordered is None else ordered  # plain data; compiled in the tasks
    # a match holds its keyword, hence the keyword's longest word as a word of the text
    gates = {max(k.split(), key=len).encode() for k in [*(r.keyword for r in ordered), *(p for p, _ in BASE)]}

    @F.pandas_udf("n_words long, base array<struct<word:long,label:string>>, "
                  "detections array<struct<first:long,end:long,label:string,weight:double>>, score double")
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(ordered)
        for batch in batches:
            rows = []
            for body in batch:
                words = words_of(body)
                if gates.isdisjoint(words):
                    rows.append((len(words), [], [], 0.0))
                    continue
                base, found = scanner.scan([w.decode("utf-8", "replace") for w in words])
                rest = 1.0
                for weight in [WEIGHT[TITLE]] * len(base) + [f[3] for f in found]:
                    rest *= 1 - weight / 2
                rows.append((
                    len(words), [{"word": w, "label": x} for w, x in base],
                    [{"first": a, "end": b, "label": x, "weight": w} for a, b, x, w in found], 1 - rest))
            yield pd.DataFrame(rows, columns=["n_words", "base", "detections", "score"])

    work = free_name(docs, "_scanned")
    out = docs.withColumn(work, detect(utf8(text)))
    for name in ("n_words", "base", "detections", "score"):
        out = out.withColumn(name, F.col(f"{work}.{name}"))
    return out.drop(work)
