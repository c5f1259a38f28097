from __future__ import annotations

import textwrap
import time

import pytest

from aerolake.llm import licenses


def scanned(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, licences string")).collect()
    return {r.doc_id: r for r in found}


def test_rules_in_order(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    rest = "You may not use this file except in compliance with the License."
    gpl = "This work is licensed under the GNU General Public License, version 3."
    grant = licenses.SENTENCES["mit_grant"][0] + ". "
    made = scanned(
        spark,
        [
            f"Some text. {apache} {rest} The end.",
            f"{rest}\n{apache}",
            f"* {gpl}\n* {gpl}",
            grant + licenses.SENTENCES["asis_short"][0].upper() + ".",
            grant + licenses.SENTENCES["mit_notice"][0] + "!\n" + licenses.SENTENCES["asis_short"][0],
            "The Apache License, Version 2.0, is not granted here.",
            "",
            None,
            "Released under the MIT License.\r\nLicensed under CC BY-NC 4.0.",
            "word " * 50_000 + ".\n" + apache,
        ],
    )
    assert made[0].licences == ["Apache-2.0"] and made[0].leftovers == [] and made[0].matches == 1
    assert made[1].licences == ["Apache-2.0"] and made[1].leftovers == ["apache2_comply"]
    assert made[2].licences == ["GPL-3.0-only"] and made[2].matches == 2
    assert made[3].licences == ["MIT-0"]
    assert made[4].licences == ["MIT"] and made[4].identifiers == ["mit_grant", "mit_notice", "asis_short"]
    for i in (5, 6, 7):
        assert made[i].licences == [] and made[i].identifiers == []
    assert made[8].licences == ["CC-BY-NC-4.0", "MIT"]
    assert made[9].licences == ["Apache-2.0"]


def test_odd_rows(odd_docs, no_docs):
    assert licenses.scan(odd_docs).count() == odd_docs.count()
    assert licenses.scan(no_docs).count() == 0


def test_known_wordings_are_normalised_and_used():
    used = {part for parts, _ in licenses.RULES for part in parts}
    for name, wordings in licenses.SENTENCES.items():
        for wording in wordings:
            assert wording == " ".join("".join(c if c.isalnum() else " " for c in wording.lower()).split())
    assert used <= set(licenses.SENTENCES)


def test_runs_without_python_workers(odd_docs):
    plan = licenses.scan(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so"
)
AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."
)
NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software."
)
APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at",
    "    http://www.apache.org/licenses/LICENSE-2.0",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed '
    'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
    "the specific language governing permissions and limitations under the License.",
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
)
GPL = (
    "This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation{1} either version {2} of the License, or (at your "
    "option) any later version."
)
HOPE = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
)
CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
LIBRARY = GPL.replace("This program", "This library").replace("GNU General", "GNU Lesser General")
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies."
)
BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and '
    "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
    "is furnished to do so, all subject to the following:"
)
ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
    "and redistribute it freely, subject to the following restrictions:",
)
DISCLAIMED = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED."
)
NAMES = {
    "bsd2_under": "BSD 2-Clause License", "bsd3_under": "3-Clause BSD License", "isc_under": "ISC License",
    "zlib_under": "zlib License", "boost_under": "Boost Software License, Version 1.0", "unlicense_under": "Unlicense",
    "mpl2_under": "Mozilla Public License 2.0", "epl2_under": "Eclipse Public License 2.0",
    "gpl2_under": "GNU General Public License, version 2", "lgpl21_under": "GNU Lesser General Public License, version 2.1",
    "lgpl3_under": "GNU Lesser General Public License, version 3", "agpl3_under": "GNU Affero General Public License, version 3",
    "psf2_under": "Python Software Foundation License",
}
# Published notices: paragraphs, licence, identifiers.
NOTICES = (
    ((LIBRARY.format(";", ";", "2.1"), HOPE.replace("program", "library")), "LGPL-2.1-or-later", "lgpl21_later lgpl_hope"),
    ((LIBRARY.format(":", ",", 3), HOPE.replace("program", "library")), "LGPL-3.0-or-later", "lgpl3_later lgpl_hope"),
    ((LIBRARY.format(";", ";", "2.1"),), "LGPL-2.1-or-later", "lgpl21_later"),
    ((LIBRARY.format(":", ",", 3),), "LGPL-3.0-or-later", "lgpl3_later"),
    ((GPL.format(":", ",", 3).replace("GNU", "GNU Affero"), HOPE), "AGPL-3.0-or-later", "agpl3_later gpl_hope"),
    ((GPL.format(":", ",", 3).replace("GNU", "GNU Affero"),), "AGPL-3.0-or-later", "agpl3_later"),
    ((ISC,), "ISC", "isc_grant"),
    ((BOOST,), "BSL-1.0", "boost_grant"),
    (ZLIB, "Zlib", "zlib_asis zlib_grant"),
    (("This is free and unencumbered software released into the public domain.",), "Unlicense", "unlicense_release"),
    (("This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 "
      "which is available at https://www.eclipse.org/legal/epl-2.0.",), "EPL-2.0", "epl2_terms"),
    ((*BSD, DISCLAIMED), "BSD-3-Clause", "bsd_permit bsd_source bsd_binary bsd_endorse bsd_disclaim"),
    ((*BSD[:3], DISCLAIMED), "BSD-2-Clause", "bsd_permit bsd_source bsd_binary bsd_disclaim"),
    *(((f"This code is distributed under the {name}.",), licenses.NAMED[x][0], x) for x, name in NAMES.items()),
    *(((f"SPDX-License-Identifier: {x}",), x, licenses.spdx_name(x)) for x in licenses.SPDX),
    (APACHE, "Apache-2.0", "apache2_under apache2_comply apache2_copy apache2_asis"),
    (APACHE[:2], "Apache-2.0", "apache2_under apache2_comply apache2_copy"),
    ((APACHE[0].split(" You")[0],), "Apache-2.0", "apache2_under apache2_comply"),
    (("Licensed under the Apache License, Version 2.0.",), "Apache-2.0", "apache2_under"),
    (("Released under the MIT License.", GRANT + ", subject to the following conditions:", NOTICE, AS_IS), "MIT",
     "mit_under mit_grant mit_notice asis_short"),
    ((GRANT + ", subject to the following conditions:", NOTICE, AS_IS), "MIT", "mit_grant mit_notice asis_short"),
    ((GRANT + ", subject to the following conditions:", NOTICE), "MIT", "mit_grant mit_notice"),
    (("This project is licensed under the MIT License.",), "MIT", "mit_under"),
    ((GRANT + ".", AS_IS), "MIT-0", "mit_grant asis_short"),
    (BSD, "BSD-3-Clause", "bsd_permit bsd_source bsd_binary bsd_endorse"),
    (BSD[:3], "BSD-2-Clause", "bsd_permit bsd_source bsd_binary"),
    (BSD[:2], "BSD-1-Clause", "bsd_permit bsd_source"),
    ((GPL.format(":", ",", 3), HOPE), "GPL-3.0-or-later", "gpl3_later gpl_hope"),
    ((GPL.format(";", ";", 2), HOPE), "GPL-2.0-or-later", "gpl2_later gpl_hope"),
    ((GPL.format(":", ",", 3),), "GPL-3.0-or-later", "gpl3_later"),
    ((GPL.format(";", ";", 2),), "GPL-2.0-or-later", "gpl2_later"),
    (("This work is licensed under the GNU General Public License, version 3.",), "GPL-3.0-only", "gpl3_under"),
    ((CC.format("-NonCommercial"),), "CC-BY-NC-4.0", "ccbync4_under"),
    ((CC.format(""),), "CC-BY-4.0", "ccby4_under"),
    ((CC.format("-ShareAlike"),), "CC-BY-SA-4.0", "ccbysa4_under"),
    (("To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
      "this work.",), "CC0-1.0", "cc0_under"),
    (("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
      "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",), "MPL-2.0", "mpl2_terms"),
)


def test_published_notices_wrapped_and_not(spark):
    """Every rule, on one line, by paragraphs, hard-wrapped and in comments."""
    assert {tuple(n.split()) for _, _, n in NOTICES} == {parts for parts, _ in licenses.RULES}
    texts, expected = [], []
    for paragraphs, licence, names in NOTICES:
        forms = [" ".join(paragraphs), "\n\n".join(paragraphs)]
        for width in (40, 60, 70, 76, 80):
            wrapped = [textwrap.wrap(p, width, break_on_hyphens=False, break_long_words=False) for p in paragraphs]
            lines = [line for p in wrapped for line in [*p, ""]]
            forms += ["\n".join(lines), "\r\n".join(lines), "some words\n\n" + "\n".join(lines) + "\nmore words"]
            forms += [f"/*\n{''.join(f' * {x}'.rstrip() + chr(10) for x in lines)} */", "\n".join(f"# {x}" for x in lines)]
            forms += ["\n".join(f"// {x}" for x in lines), "\n".join(f"dnl {x}" for x in lines)]
        texts += forms
        expected += [(licence, names)] * len(forms)
    made = scanned(spark, texts)
    for i, (licence, names) in enumerate(expected):
        assert (made[i].licences, made[i].identifiers) == ([licence], names.split()), texts[i]


def test_sentences_end_where_they_end(spark):
    """No wording reaches over a full stop, a blank line or a list item; an opening is known by its start."""
    made = scanned(
        spark,
        [
            "This work is licensed under the GNU General Public License. Version 3.",
            "Released under the\n\nMIT License.",
            "Released under the\n- MIT License.",
            "Not released under the MIT License.",
            "Released under the MIT License or another.",
            GPL.format(":", ",", 3).replace("GNU", "GNU Other"),
            "(a) Released under the MIT License; (b) see\n(ii) Licensed under CC BY 4.0",
            "HS Released under the MIT License S H",
        ],
    )
    assert [made[i].identifiers for i in range(5)] == [[]] * 5
    assert made[5].identifiers == made[5].leftovers == ["gpl_redistribute"]
    assert made[6].licences == ["CC-BY-4.0", "MIT"]
    assert made[7].identifiers == []


def test_usual_short_forms(spark):
    texts = [
        "Licensed under the Apache License 2.0.", "This code is distributed under the MIT License.",
        "// SPDX-License-Identifier: Apache-2.0\n", "/* SPDX-License-Identifier: LGPL-2.1-or-later */",
        "SPDX-License-Identifier: MIT OR Apache-2.0",
    ]
    made = scanned(spark, texts)
    assert [made[i].licences for i in range(5)] == [["Apache-2.0"], ["MIT"], ["Apache-2.0"], ["LGPL-2.1-or-later"], []]


RUNS = (
    ".", "!", "?", ":", ";", "-", "•", " ", "\t", "\n", "\r", "\r\n", "://", "http://", "https://x", ". ", ".,", ". . ", "\n.", "\n-", "\n- ",
    "1)", "\n1)", "v.", "v. ", "dnl", "\ndnl ", "(", "H", "S ", ": ", "licensed under ", "\u00e9", "a", "0",
)


@pytest.mark.parametrize("run", RUNS)
def test_long_runs_take_time_in_proportion(spark, run):
    """A megabyte of any mark: well under a second once the code is warm, and the sentence after it is known."""
    text = run * (1_000_000 // len(run)) + "\n\nReleased under the MIT License.\n"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1)
    start = time.perf_counter()
    row = licenses.scan(docs).first()
    assert time.perf_counter() - start < 5
    assert row.licences == ["MIT"]
