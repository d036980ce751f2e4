"""Real statements that the license rules must find."""

import re

from creditmart.llm import licenses

SCANNER = licenses.Scanner(licenses.rules())

# one text for each of licenses.SENTENCES, in their order
SENTENCES = """\
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
MIT No Attribution
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
Redistribution and use in source and binary forms, with or without modification, are permitted provided
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
All advertising materials mentioning features or use of this software must display the following acknowledgement: This product
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
http://www.apache.org/licenses/LICENSE-2.0
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as
under the terms of the GNU Affero General Public License as published
https://www.gnu.org/licenses/
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
http://mozilla.org/MPL/2.0/
This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0
This is free and unencumbered software released into the public domain.
You just DO WHAT THE FUCK YOU WANT TO.
The origin of this software must not be misrepresented; you must not
Boost Software License - Version 1.0 - August 17th, 2003
The Artistic License 2.0
The person who associated a work with this deed has dedicated the work to the public domain
placed into the public domain
All rights reserved.
Proprietary and confidential
Unauthorized copying of this file, via any medium is strictly prohibited
for personal and non-commercial use only
This Font Software is licensed under the SIL Open Font License, Version 1.1.
PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2
This product includes software developed by the OpenSSL Project
The PHP License, version 3.01
COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL)
Microsoft Public License (Ms-PL)
Microsoft Reciprocal License (Ms-RL)
University of Illinois/NCSA Open Source License
PostgreSQL License
curl license
Open Government Licence v3.0
""".splitlines()


def found(text):
    return {label for *_, label, _ in SCANNER.scan([w.decode() for w in licenses.words_of(text.encode())])[1]}


def test_every_sentence_is_found_in_a_real_text():
    assert len(SENTENCES) == len(licenses.SENTENCES)
    for (label, keyword, pattern), text in zip(licenses.SENTENCES, SENTENCES):
        alone = licenses.Scanner([licenses.Rule(label, pattern, keyword, 0)])
        words = [w.decode() for w in licenses.words_of(text.encode())]
        assert alone.scan(words)[1], text
        assert max(keyword.split(), key=len) in words, text


def test_both_spellings_of_the_advertising_clause():
    text = "All advertising materials mentioning features or use of this software must display the following "
    assert found(text + "acknowledgement:") == found(text + "acknowledgment:") == {"bsd-4-clause"}


STATEMENTS = (
    ("SPDX-License-Identifier: Apache-2.0", {"apache-2.0"}), ("SPDX-License-Identifier: MIT", {"mit"}),
    ("SPDX-License-Identifier: BSD-3-Clause", {"bsd-3-clause"}), ("SPDX-License-Identifier: BSD-3-Clause-Clear", {"bsd-3-clause-clear"}),
    ("// SPDX-License-Identifier: GPL-2.0+", {"gpl-2.0"}), ("SPDX-License-Identifier: LGPL-2.1-only", {"lgpl-2.1"}),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", {"mit", "apache-2.0"}), ("SPDX-License-Identifier: Apache-2.0 OR MIT", {"mit", "apache-2.0"}),
    ("SPDX-License-Identifier: BSL-1.0", {"boost"}), ("SPDX-License-Identifier: BUSL-1.1", {"bsl-1.1"}),
    ("SPDX-License-Identifier: CC0-1.0", {"cc0-1.0"}), ("SPDX-License-Identifier: CC-BY-SA-4.0", {"cc-by-sa-4.0"}),
    ("GPLv2", {"gpl-2.0"}), ("GPLv3", {"gpl-3.0"}), ("GPLv3+", {"gpl-3.0"}), ("LGPLv2.1", {"lgpl-2.1"}), ("AGPLv3", {"agpl-3.0"}),
    ("GNU GPLv3", {"gpl-3.0"}), ("GPL-3.0-or-later", {"gpl-3.0"}), ("GPL v2 only", {"gpl-2.0"}), ("GPL2", {"gpl-2.0"}),
    ("under the terms of the GNU GPL", {"gpl"}), ("Apache 2.0", {"apache-2.0"}), ("Apache License v2.0", {"apache-2.0"}),
    ("Licensed under the Apache License", {"apache"}), ("licensed under the GPL license", {"gpl"}), ("Released under the MIT License.", {"mit"}),
    ("New BSD License", {"bsd-3-clause"}), ("3-Clause BSD", {"bsd-3-clause"}), ("the Acme License", set()),
    ("licensed under the Acme license", {"unspecified"}), ("MPLv2", {"mpl-2.0"}), ("https://opensource.org/licenses/MIT", {"mit"}),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", {"cc-by-nc-sa-4.0"}), ("Mozilla Public License, version 2.0", {"mpl-2.0"}),
    ("Creative Commons Attribution-ShareAlike 3.0 Unported License", {"cc-by-sa-3.0"}),
    ("the GNU General Public License as published by the Free Software Foundation; either version 3 of the License", {"gpl-3.0"}),
    ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/", {"apache-2.0"}))


def test_real_statements():
    wrong = [(text, found(text), expected) for text, expected in STATEMENTS if found(text) != expected]
    assert not wrong


def passes(rule, text):
    words = [w.decode() for w in licenses.words_of(text.encode())]
    return licenses.Scanner([rule]).scan(words)[1] and max(rule.keyword.split(), key=len) in words


def test_every_name_and_tag_is_found_and_no_rule_is_repeated():
    ordered = licenses.rules()
    assert len({r.pattern for r in ordered}) == len(ordered)
    rules = {r.keyword + r.pattern: r for r in ordered}
    for lines, tail in ((licenses.TITLES, ""), (licenses.MENTIONS, "(?: licen[cs]e)?")):
        for line, rule in zip(lines.strip().splitlines(), licenses._listed(lines, 0, tail)):
            head, _, rest = line.partition(": ")[2].partition("|")
            rest = re.sub(r"\(\?:([^()]*)\)\?", "", rest)
            rest = rest.replace("V", " v").replace("L", "").replace("[^ ]+", "acme")
            text = head + re.sub(r"\[(.)[^]]*\]", r"\1", rest)
            if "(?<=" in rest:
                text = f"2 0 {head}"
            assert passes(rule, text), line
            assert rule.keyword + rule.pattern in rules
    for name in licenses.SPDX:
        assert found(f"SPDX-License-Identifier: {name}") == {
            licenses.OTHER_LABELS.get(x := name.lower().removesuffix("-only").removesuffix("-or-later"), x)}, name
    for rule in ordered:
        if rule.keyword == "creative commons":
            assert passes(rule, rule.pattern.replace(" ?", "").replace("(?:ative)?", "ative").replace("s?", "s")), rule
    for _, keyword, pattern in licenses.MORE_SENTENCES:
        text = re.sub(r"\(\?:[^()]*\)\?", "", pattern).replace("(?:lesser|library)", "library")
        assert passes(licenses.Rule("x", pattern, keyword, 0), text), pattern
