"""Licence scan by sentence rules, in built-in functions only.

A text is lower-cased and cut into words with marks between them. Full stops, blank lines and list items
end a sentence for good; a line end, a colon or a semicolon may end one or lie inside one, so a sentence is
known whether it is hard-wrapped, commented out line by line or on one line. A known sentence gives its
identifier, the longest one where several begin at a place. The identifiers in text order are then matched
against ordered rules: a rule is a run of identifiers and the licence it stands for. Rules are tried in
their order, the more specific ones first, and what a rule has matched is used up, so a sentence counts
once. Known sentences that no rule takes are returned as leftovers.

Everything is computed inside a row: nothing is shuffled, and a row's work follows its own text. Null
texts count as empty: no sentences, no licences. Null doc_ids and repeated rows are scanned as rows of
their own. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, normalised; identifier -> wordings.
SENTENCES: dict[str, tuple[str, ...]] = {
    "apache2_under": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
    ),
    "apache2_comply": ("you may not use this file except in compliance with the license",),
    "apache2_copy": (
        "you may obtain a copy of the license at",
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
    ),
    "apache2_asis": (
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "mit_under": (
        "released under the mit license",
        "licensed under the mit license",
        "this software is released under the mit license",
        "this project is licensed under the mit license",
    ),
    "mit_grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "mit_notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software",
    ),
    "asis_short": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "gpl3_under": (
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "licensed under the gnu gpl version 3",
    ),
    "gpl_redistribute": ("this program is free software you can redistribute it and or modify it under the terms of the",),
    "gpl3_later": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
    ),
    "gpl2_later": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 2 of the license or at your "
        "option any later version",
    ),
    "gpl_hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose",
    ),
    "ccbync4_under": (
        "licensed under cc by nc 4 0",
        "this work is licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ),
    "ccby4_under": (
        "licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    "ccbysa4_under": (
        "licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ),
    "cc0_under": ("released under cc0 1 0", "to the extent possible under law the author has waived all copyright"),
    "mpl2_terms": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "bsd_permit": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    "bsd_source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    ),
    "bsd_binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd_endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "lgpl21_later": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation either version 2 1 of the license or at your "
        "option any later version",
    ),
    "lgpl3_later": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
    ),
    "lgpl_hope": (
        "this library is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose",
    ),
    "agpl3_later": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
    ),
    "isc_grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "unlicense_release": ("this is free and unencumbered software released into the public domain",),
    "boost_grant": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
        "transmit the software and to prepare derivative works of the software and to permit third parties to whom the "
        "software is furnished to do so all subject to the following",
    ),
    "epl2_terms": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license v2 0",
    ),
    "zlib_asis": ("this software is provided as is without any express or implied warranty",),
    "zlib_grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to "
        "alter it and redistribute it freely subject to the following restrictions",
    ),
    "bsd_disclaim": (
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed",
    ),
    "all_reserved": ("all rights reserved",),
}
# Licences by their SPDX identifiers, as named in one line of a file.
SPDX = (
    "MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "Unlicense", "CC0-1.0",
    "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "MPL-2.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only",
    "AGPL-3.0-or-later", "PSF-2.0",
)
# Usual names of licences in a sentence that only refers to them; identifier -> licence, names.
NAMED: dict[str, tuple[str, tuple[str, ...]]] = {
    "mit_under": ("MIT", ("mit license",)),
    "apache2_under": ("Apache-2.0", ("apache license 2 0", "apache license version 2 0")),
    "bsd2_under": ("BSD-2-Clause", ("bsd 2 clause license", "2 clause bsd license")),
    "bsd3_under": ("BSD-3-Clause", ("bsd 3 clause license", "3 clause bsd license")),
    "isc_under": ("ISC", ("isc license",)),
    "zlib_under": ("Zlib", ("zlib license",)),
    "boost_under": ("BSL-1.0", ("boost software license version 1 0", "boost software license 1 0")),
    "unlicense_under": ("Unlicense", ("unlicense",)),
    "mpl2_under": ("MPL-2.0", ("mozilla public license 2 0", "mozilla public license version 2 0")),
    "epl2_under": ("EPL-2.0", ("eclipse public license 2 0", "eclipse public license version 2 0")),
    "gpl2_under": ("GPL-2.0-only", ("gnu general public license version 2", "gnu gpl version 2")),
    "gpl3_under": ("GPL-3.0-only", ("gnu general public license version 3", "gnu gpl version 3")),
    "lgpl21_under": ("LGPL-2.1-only", ("gnu lesser general public license version 2 1",)),
    "lgpl3_under": ("LGPL-3.0-only", ("gnu lesser general public license version 3",)),
    "agpl3_under": ("AGPL-3.0-only", ("gnu affero general public license version 3",)),
    "psf2_under": ("PSF-2.0", ("python software foundation license", "python software foundation license version 2")),
}
# Sentences around such a name.
REFERRING = (
    "licensed under the {}", "released under the {}", "distributed under the {}", "this project is licensed under the {}",
    "this software is released under the {}", "this code is distributed under the {}", "this work is licensed under the {}",
)


def spdx_name(licence: str) -> str:
    return "spdx_" + licence.lower().replace("-", "_").replace(".", "_")


for _licence in SPDX:
    SENTENCES[spdx_name(_licence)] = ("spdx license identifier " + _licence.lower().replace("-", " ").replace(".", " "),)
for _identifier, (_, _names) in NAMED.items():
    _told = [form.format(name) for name in _names for form in REFERRING]
    SENTENCES[_identifier] = tuple(dict.fromkeys([*SENTENCES.get(_identifier, ()), *_told]))

# Further published wordings, which the SQL does not state.
PUBLISHED: dict[str, tuple[str, ...]] = {
    # MIT-0 sets no conditions.
    "mit_grant": (SENTENCES["mit_grant"][0].removesuffix(" subject to the following conditions"),),
}
# Wordings that end inside their published sentence; any words may follow.
OPENINGS = (
    SENTENCES["gpl_redistribute"][0],
    "you may obtain a copy of the license at",
    "to the extent possible under law the author has waived all copyright",
    *SENTENCES["epl2_terms"],
)

# Ordered rules; the run of identifiers on the left is the licence on the right.
RULES: tuple[tuple[tuple[str, ...], str], ...] = (
    (("apache2_under", "apache2_comply", "apache2_copy", "apache2_asis"), "Apache-2.0"),
    (("apache2_under", "apache2_comply", "apache2_copy"), "Apache-2.0"),
    (("apache2_under", "apache2_comply"), "Apache-2.0"),
    (("mit_under", "mit_grant", "mit_notice", "asis_short"), "MIT"),
    (("mit_grant", "mit_notice", "asis_short"), "MIT"),
    (("mit_grant", "mit_notice"), "MIT"),
    (("mit_grant", "asis_short"), "MIT-0"),
    (("bsd_permit", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_disclaim"), "BSD-3-Clause"),
    (("bsd_permit", "bsd_source", "bsd_binary", "bsd_endorse"), "BSD-3-Clause"),
    (("bsd_permit", "bsd_source", "bsd_binary", "bsd_disclaim"), "BSD-2-Clause"),
    (("bsd_permit", "bsd_source", "bsd_binary"), "BSD-2-Clause"),
    (("bsd_permit", "bsd_source"), "BSD-1-Clause"),
    (("gpl3_later", "gpl_hope"), "GPL-3.0-or-later"),
    (("gpl2_later", "gpl_hope"), "GPL-2.0-or-later"),
    (("lgpl21_later", "lgpl_hope"), "LGPL-2.1-or-later"),
    (("lgpl3_later", "lgpl_hope"), "LGPL-3.0-or-later"),
    (("agpl3_later", "gpl_hope"), "AGPL-3.0-or-later"),
    (("lgpl21_later",), "LGPL-2.1-or-later"),
    (("lgpl3_later",), "LGPL-3.0-or-later"),
    (("agpl3_later",), "AGPL-3.0-or-later"),
    (("zlib_asis", "zlib_grant"), "Zlib"),
    (("isc_grant",), "ISC"),
    (("unlicense_release",), "Unlicense"),
    (("boost_grant",), "BSL-1.0"),
    (("epl2_terms",), "EPL-2.0"),
    (("gpl3_later",), "GPL-3.0-or-later"),
    (("gpl2_later",), "GPL-2.0-or-later"),
    *(((_identifier,), _licence) for _identifier, (_licence, _) in NAMED.items()),
    *(((spdx_name(_licence),), _licence) for _licence in SPDX),
    (("ccbync4_under",), "CC-BY-NC-4.0"),
    (("ccby4_under",), "CC-BY-4.0"),
    (("ccbysa4_under",), "CC-BY-SA-4.0"),
    (("cc0_under",), "CC0-1.0"),
    (("mpl2_terms",), "MPL-2.0"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Texts are in lower case when they are marked, so capitals are free for marks.
END = r"(?>\r\n?|\n)"
# Words that begin a comment line; other comment markers are no words.
COMMENT = rf"(^|{END})[ \t]*(?:dnl|rem)(?![^ \t\r\n])"
VERSION = r"(?<![a-z0-9])v\.[^a-z0-9]++(?=[0-9])"
# Every pattern below looks at a long run of any mark from its first character only, or takes it whole, so that it
# takes time in proportion to its length.
# An address, after which a sentence may end or go on (S).
ADDRESS = r"(?<!\S)((?>\S*?https?://)\S++)[ \t]+"
# The marker of a list item, which ends a sentence for good (H), as do a stop before white space, a line without
# words and a dash that begins a line.
ITEM = rf"((?:^|{END})[^a-z0-9\r\n]*(?:[0-9]{{1,2}}|[a-z]|[ivx]{{2,4}})\))[ \t]+"
# A stop looks to the end of its run of marks unless another one close before it has.
HARD = (
    rf"[.!?](?:[ \t]+|(?<![.!?][^a-z0-9\r\n]{{0,64}}[.!?])[^a-z0-9\r\n]*+{END})"
    rf"|{END}[^a-z0-9\r\n]*+{END}|(?:^|{END})[ \t]*+[-•][ \t]+"
)
# May end a sentence or lie inside one (S): a line end, a colon, a semicolon.
SOFT = rf"[:;][ \t]+|{END}"
NOT_WORD = "[^a-z0-9HS]++"


def known() -> dict[str, str]:
    """Normalised wording -> identifier."""
    return {wording: name for name, wordings in SENTENCES.items() for wording in wordings}


def wordings() -> dict[str, str]:
    """All normalised wordings, longest first -> identifier."""
    more = {wording: name for name, listed in PUBLISHED.items() for wording in listed}
    return dict(sorted((known() | more).items(), key=lambda x: (-len(x[0]), x[0])))


def _where_held(text: Column, pattern: str, put: str, needed: str) -> Column:
    """The text with the pattern replaced; left as it is where it lacks ``needed``. A lambda names the text, which
    would else be computed for the test and for the replacement."""

    def replaced(named: Column) -> Column:
        return F.when(F.contains(named, F.lit(needed)), F.regexp_replace(named, pattern, put)).otherwise(named)

    return F.get(F.transform(F.array(text), replaced), F.lit(0))


def marked(text: Column) -> Column:
    """Lower-case words and marks, a blank between each two, a mark at both ends."""
    made = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    # Pattern, what is put for it, and a text without which there is nothing to find.
    marks = (
        (COMMENT, "$1", None), (VERSION, "v ", "v."), (ADDRESS, "$1 S ", "://"), (ITEM, "$1 H ", ")"), (HARD, " H ", None),
        (SOFT, " S ", None), (NOT_WORD, " ", None),
    )
    for pattern, put, needed in marks:
        if needed is None:
            made = F.regexp_replace(made, pattern, put)
        else:
            made = _where_held(made, pattern, put, needed)
    return F.concat(F.lit("H "), F.trim(made), F.lit(" H"))


def identifiers(text: Column) -> Column:
    """The known sentences' identifiers, in text order."""
    names = wordings()
    each = [w.replace(" ", "[ S]++") + ("(?= )" if w in OPENINGS else "(?= [HS])") for w in names]
    found = F.regexp_extract_all(marked(text), F.lit(f"[HS] ({'|'.join(each)})"), F.lit(1))
    listed = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.transform(found, lambda s: F.element_at(listed, F.replace(s, F.lit(" S"), F.lit(""))))


def resolve(found: Column) -> Column:
    """The identifier run with every rule's matches replaced by its licence: ``<licence>`` or ``[identifier]``."""
    run = F.array_join(F.transform(found, lambda x: F.concat(F.lit("["), x, F.lit("]"))), "")
    for parts, licence in RULES:
        run = F.replace(run, F.lit("".join(f"[{p}]" for p in parts)), F.lit(f"<{licence}>"))
    return run


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the identifiers in order, the licences (sorted, each once) and the leftover identifiers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), identifiers(F.col("text")).alias("identifiers"))
    rows = rows.withColumn("run", resolve(F.col("identifiers")))
    picked = F.regexp_extract_all("run", F.lit("<([^>]+)>"), F.lit(1))
    left = F.regexp_extract_all("run", F.lit(r"\[([^\]]+)\]"), F.lit(1))
    return rows.select(
        "doc_id",
        "identifiers",
        F.array_sort(F.array_distinct(picked)).alias("licences"),
        left.alias("leftovers"),
        F.size(picked).cast("long").alias("matches"),
    )
