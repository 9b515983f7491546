"""Licence recognition by sentences.

A text is cut into sentences, which end at a stop, mark or semicolon before white space, or at a blank line; a sentence may go on
over line ends, and a line, or the lines from any one to the sentence's end or to a colon at a line's end, may be a sentence as well, so that headings and wrapping do no
harm. Each is normalised (lower case, letters, digits and dots in numbers, single blanks) and mapped to the identifier of a known licence
sentence, if it is one. The text's sequence of identifiers is matched against ordered rules: a rule holds if its identifiers occur in
its order with at most ``gap`` other known sentences in between. List marks are not read, owners' names and the tails of notices are slots that any words fill,
and a notice or an SPDX expression that names several licences counts as one notice for each. The first rules take their sentences first, so that a specific licence hides a
general one. Sentences that no rule has used are reported as unmatched.

Map-only, in DataFrame operations. Sentences that are not known are dropped by a hash look-up before anything else
is done with them.

Defined results: a null or empty text has no sentences and no licences; repeated sentences count once each; repeated rows give
repeated results; extra columns are kept but for those the result needs, which get new names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, quoted

#: Known licence sentences, by identifier.
SENTENCES = {
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "zero-bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache2-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2-comply": "you may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-unless": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "gpl2-free": "This program is free software;",
    "gpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-later": "either version 2 of the License, or (at your option) any later version.",
    "gpl2-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl3-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl3-only": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3.",
    "agpl3-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl21-free": "This library is free software;",
    "lgpl21-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl21-later": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-later": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl2-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl-header": "Distributed under the Boost Software License, Version 1.0.",
    "wtfpl-what": "You just DO WHAT THE FUCK YOU WANT TO.",
    "ofl-header": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "epl2-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl1-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "postgres-grant": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
    "cc0-header": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "all-rights": "All rights reserved.",
    "bsd-endorse-author": "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization.",
    "lgpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation;",
    "gpl1-title": "GNU GENERAL PUBLIC LICENSE Version 1, February 1989",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl2-title": "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "gfdl13-title": "GNU Free Documentation License Version 1.3, 3 November 2008",
    "apache2-title": "Apache License Version 2.0, January 2004",
    "apache2-title-where": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "mpl11-title": "Mozilla Public License Version 1.1",
    "epl1-title": "Eclipse Public License - v 1.0",
    "epl2-title": "Eclipse Public License - v 2.0",
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "artistic2-title": "The Artistic License 2.0",
    "cddl1-title": "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0",
    "ofl-title": "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
}
#: Licences and the names that notices call them by.
NAMES = {
    "MIT": ["MIT License", "Expat License", "X11 License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "ISC": ["ISC License"],
    "0BSD": ["BSD Zero Clause License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "CC0-1.0": ["CC0 1.0", "Creative Commons CC0 1.0 Universal License"],
    "CC-BY-3.0": ["CC BY 3.0", "Creative Commons Attribution 3.0 Unported License"],
    "CC-BY-SA-3.0": ["CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0"],
    "WTFPL": ["WTFPL"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "CDDL-1.0": ["Common Development and Distribution License 1.0", "CDDL 1.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "EUPL 1.2"],
    "OFL-1.1": ["SIL Open Font License 1.1", "SIL Open Font License, Version 1.1"],
    "PostgreSQL": ["PostgreSQL License"],
    "MS-PL": ["Microsoft Public License"],
    "Python-2.0": ["Python Software Foundation License"],
    "BSD-4-Clause": ["BSD 4-Clause License", "Original BSD License"],
    "MIT-0": ["MIT No Attribution License", "MIT No Attribution"],
    "MPL-1.1": ["Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1"],
    "AFL-3.0": ["Academic Free License 3.0", "Academic Free License version 3.0"],
    "OSL-3.0": ["Open Software License 3.0", "Open Software License version 3.0"],
    "Artistic-1.0": ["Artistic License 1.0"],
    "CPL-1.0": ["Common Public License 1.0", "Common Public License Version 1.0"],
    "NCSA": ["University of Illinois/NCSA Open Source License", "NCSA License"],
    "Apache-1.1": ["Apache License, Version 1.1", "Apache License 1.1", "Apache Software License 1.1"],
    "CC-BY-2.0": ["CC BY 2.0", "Creative Commons Attribution 2.0 Generic License"],
    "CC-BY-SA-2.0": ["CC BY-SA 2.0", "Creative Commons Attribution-ShareAlike 2.0 Generic License"],
    "PHP-3.01": ["PHP License, version 3.01", "PHP License 3.01"],
    "UPL-1.0": ["Universal Permissive License v1.0", "Universal Permissive License 1.0"],
    "SSPL-1.0": ["Server Side Public License, version 1", "Server Side Public License v1"],
    "BUSL-1.1": ["Business Source License 1.1"],
    "Elastic-2.0": ["Elastic License 2.0"],
    "MulanPSL-2.0": ["Mulan PSL v2", "Mulan Permissive Software License, Version 2"],
    "LPPL-1.3c": ["LaTeX Project Public License, version 1.3c", "LaTeX Project Public License 1.3c"],
    "MS-RL": ["Microsoft Reciprocal License"],
    "BlueOak-1.0.0": ["Blue Oak Model License 1.0.0"],
}
#: Families of licences with their versions.
FAMILIES = {
    "GPL": ("GNU General Public License", ["1", "2", "3"]),
    "LGPL": ("GNU Lesser General Public License", ["2", "2.1", "3"]),
    "AGPL": ("GNU Affero General Public License", ["1", "3"]),
    "GFDL": ("GNU Free Documentation License", ["1.1", "1.2", "1.3"]),
}


def named_versions() -> dict[str, list[str]]:
    """Names of each version of a family, alone and "or later", by rule."""
    out = {}
    for short, (full, versions) in FAMILIES.items():
        for v in versions:
            dotted = v if "." in v else f"{v}.0"
            spellings = [f"{short}{x}{y}" for x in (" ", "v", " v", " version ") for y in {v, dotted}] + [f"{full} {x}{y}" for x in ("v", "version ", "") for y in {v, dotted}]
            out[f"{short}-{dotted}-only"] = sorted([*spellings, *(f"{s} only" for s in spellings)])
            out[f"{short}-{dotted}-or-later"] = sorted(f"{s} or {x}later" for s in spellings for x in ("", "any "))
    return out


NAMES |= named_versions()
#: How notices begin before the licence's name, in the normal form; all are read as "notice".
NOTICE = r"^(?:this (?:work|software|project|program|library|package|code|file) is |it is )?(?:dual |double )?(?:licensed|released|distributed|available|published) under (?:the terms (?:and conditions )?of )?(?:either )?(?:of )?(?:the |an? )?"
SPDX = "^spdx license identifier "
#: How all that ``told`` changes begins.
BEGINNINGS = "^(?:this |it is |dual |double |licensed |released |distributed |available |published |notice |spdx |neither the |the name|all advertising )"
#: What may follow a licence's name in a notice, in the normal form.
TAIL = r"^(notice .*?) (?:see|as (?:described|found|stated) in|(?:which is )?(?:found|included) in|for (?:more )?details|at your option|with no warranty)(?: .*)?$"
#: Slots: sentences in the normal form that any owner's name may stand in, and how they are read.
SLOTS = [
    (r"^neither the names? of .{1,160}? nor the names? of (?:its |their |his |her |any |the )?(?:contributors|authors) ", "neither the name of the copyright holder nor the names of its contributors "),
    (r"^the names? of .{1,160}? may not be used to endorse ", "the name of the author may not be used to endorse "),
    (r"^(all advertising materials mentioning features or use of this software must display the following) acknowledge?ment this product includes software developed by .*$", "$1 acknowledgement this product includes software developed by the organization"),
]
#: Ordered rules of licences in full: licence, then the identifiers in their order. Notices come after these.
FULL_RULES = [
    ("GPL-2.0-only", ["gpl2-title", "gpl2-free", "gpl2-redistribute", "gpl2-later"]),
    ("GPL-3.0-only", ["gpl3-title", "gpl3-later"]),
    ("AGPL-3.0-only", ["agpl3-title", "agpl3-later"]),
    ("LGPL-2.1-only", ["lgpl21-title", "lgpl21-free", "lgpl21-redistribute", "lgpl21-later"]),
    ("LGPL-2.0-only", ["lgpl2-title", "lgpl21-free", "lgpl2-redistribute", "gpl2-later"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("0BSD", ["zero-bsd-grant", "isc-as-is"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse-author"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-author"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache2-header", "apache2-comply"]),
    ("AGPL-3.0-or-later", ["agpl3-later"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-3.0-only", ["gpl3-only"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl2-redistribute", "gpl2-later"]),
    ("GPL-2.0-only", ["gpl2-free", "gpl2-only"]),
    ("LGPL-2.0-or-later", ["lgpl21-free", "lgpl2-redistribute", "gpl2-later"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl21-redistribute", "lgpl21-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-later"]),
    ("MPL-2.0", ["mpl2-header", "mpl2-copy"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
    ("BSL-1.0", ["bsl-header"]),
    ("WTFPL", ["wtfpl-what"]),
    ("OFL-1.1", ["ofl-header"]),
    ("EPL-2.0", ["epl2-header"]),
    ("EPL-1.0", ["epl1-header"]),
    ("PostgreSQL", ["postgres-grant"]),
    ("CC0-1.0", ["cc0-header"]),
    ("GPL-1.0-only", ["gpl1-title"]),
    ("GPL-2.0-only", ["gpl2-title"]),
    ("GPL-3.0-only", ["gpl3-title"]),
    ("LGPL-2.0-only", ["lgpl2-title"]),
    ("LGPL-2.1-only", ["lgpl21-title"]),
    ("LGPL-3.0-only", ["lgpl3-title"]),
    ("AGPL-3.0-only", ["agpl3-title"]),
    ("GFDL-1.3-only", ["gfdl13-title"]),
    ("Apache-2.0", ["apache2-title"]),
    ("Apache-2.0", ["apache2-title-where"]),
    ("MPL-2.0", ["mpl2-title"]),
    ("MPL-1.1", ["mpl11-title"]),
    ("EPL-1.0", ["epl1-title"]),
    ("EPL-2.0", ["epl2-title"]),
    ("BSL-1.0", ["bsl-title"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Artistic-2.0", ["artistic2-title"]),
    ("CDDL-1.0", ["cddl1-title"]),
    ("OFL-1.1", ["ofl-title"]),
]
LAST_RULES = [("Proprietary", ["all-rights"])]


def identifier(licence: str) -> str:
    return f"notice-{licence.lower().replace('.', '-')}"


def known_sentences() -> dict[str, list[str]]:
    """All known sentences by identifier: those stated, and a notice for each name of a licence."""
    return {name: [text] for name, text in SENTENCES.items()} | {identifier(x): [f"notice {n}" for n in [*names, x]] for x, names in NAMES.items()}


RULES = [*FULL_RULES, *((licence, [identifier(licence)]) for licence in NAMES), *LAST_RULES]
#: A sentence ends at a stop (but not one of these abbreviations'), mark or semicolon before white space, or at a blank line.
ABBREVIATIONS = ["inc", "ltd", "corp", "co", "jr", "dr"]
END = "(?i)" + "".join(rf"(?<!\b{a})" for a in ABBREVIATIONS) + r"[.!?;]+(?=\s|$)|\r?\n[^\p{L}\p{N}\n]*\r?\n"
LINE_END = r"[\r\n]+"
#: List marks in brackets; those with a stop are sentences of their own.
MARK = r"^[^\p{L}\p{N}(]*\(?(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})\)\s+"
#: What stands between licences in a notice and in an SPDX expression.
OR = " or (?!(?:any )?later)(?:the )?"
BETWEEN = " or (?!later)| and | with "


def normalised(sentence: Column) -> Column:
    """Lower case; everything but letters, digits and dots between digits is a gap; a notice begins with "notice"."""
    low = F.lower(sentence)
    plain = F.when(F.contains(sentence, F.lit(")")), F.regexp_replace(low, MARK, "")).otherwise(low)
    plain = F.replace(F.replace(plain, F.lit("+"), F.lit(" or later ")), F.lit("licence"), F.lit("license"))
    plain = F.trim(F.regexp_replace(plain, r"(?:(?<![0-9])\.|\.(?![0-9])|[^\p{L}\p{N}.])+", " "))
    return F.transform(F.array(plain), told)[0]  # so that it is made once


def told(sentence: Column) -> Column:
    """The normal form with notices, SPDX expressions and slots read alike. ``sentence``: a lambda's variable, since it stands here twice."""
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(sentence, NOTICE, "notice "), SPDX, "spdx "), TAIL, "$1")
    for slot, filled in SLOTS:
        out = F.regexp_replace(out, slot, filled)
    return F.when(sentence.rlike(BEGINNINGS), out).otherwise(sentence)


def entries(sentence: Column) -> Column:
    """What a sentence in the normal form is looked up as: itself, and for each licence that it offers a notice."""
    spdx = F.transform(F.split(F.substr(sentence, F.lit(len("spdx ") + 1)), BETWEEN), lambda x: F.concat(F.lit("notice "), x))
    offered = F.split(F.substr(sentence, F.lit(len("notice ") + 1)), OR)
    either = F.concat(F.array(sentence), F.transform(offered, lambda x: F.concat(F.lit("notice "), x)))
    several = F.startswith(sentence, F.lit("notice ")) & sentence.rlike(OR)
    return F.when(F.startswith(sentence, F.lit("spdx ")), spdx).when(several, either).otherwise(F.array(sentence))


def hash_of(spark: SparkSession, sentences: dict[str, list[str]]) -> tuple[dict[int, str], int]:
    """The hash of each known sentence in its normal form, by the engine's own functions, and the most words of one."""
    told = spark.createDataFrame([(name, text) for name, texts in sentences.items() for text in texts], "name string, text string")
    rows = told.select("name", normalised(F.col("text")).alias("text")).select("name", F.xxhash64("text").alias("h"), F.size(F.split("text", " ")).alias("n")).collect()
    return {r["h"]: r["name"] for r in rows}, max(r["n"] for r in rows)


def recognised(docs: DataFrame, sentences: dict[str, list[str]] | None = None, rules: list[tuple[str, list[str]]] = RULES, gap: int = 5, text_column: str = "text") -> DataFrame:
    """``docs`` with licence_sentences (identifiers in order), licences (in the rules' order, each once) and unmatched."""
    known, most = hash_of(docs.sparkSession, sentences or known_sentences())
    names = docs.columns
    # Each one literal, so that copies of the expression, which filters on the result make, stay small.
    hashes = F.from_json(F.lit(json.dumps(list(known))), "array<bigint>")
    name = F.from_json(F.lit(json.dumps({str(h): n for h, n in known.items()})), "map<string, string>")
    lines, found, state = (fresh(x, names) for x in ("lines_of_sentences", "found_sentences", "rules_so_far"))
    made = [fresh(x, names) for x in ("licence_sentences", "licences", "unmatched")]
    cut = F.split(F.coalesce(quoted(text_column).cast("string"), F.lit("")), END)
    line = lambda x: F.struct(normalised(x).alias("said"), x.rlike(r":\s*$").alias("opens"))
    normal_lines = F.transform(cut, lambda s: F.filter(F.transform(F.split(s, LINE_END), line), lambda x: x["said"] != ""))

    def hits(lines_: Column) -> Column:
        sentence = lines_["said"]

        def look_up(said: Column) -> Column:
            return F.filter(F.transform(F.flatten(F.transform(said, entries)), lambda x: F.xxhash64(x)), lambda h: F.array_contains(hashes, h))

        alone = look_up(sentence)
        n = F.size(sentence)
        # Each line has a word, so lines further from the end belong to no known sentence that ends there.
        joined = F.transform(F.sequence(F.greatest(n - most, F.lit(1)), n - 1), lambda i: F.array_join(F.slice(sentence, i, n - i + 1), " "))
        joined = F.transform(joined, told)
        # What a line with a colon ends may be a sentence too, as before a list.
        opening = F.filter(F.sequence(F.lit(1), n - 1), lambda j: (j > 1) & F.element_at(lines_, j)["opens"])
        before = F.flatten(F.transform(opening, lambda j: F.transform(F.sequence(F.greatest(j - most, F.lit(1)), j - 1), lambda i: F.array_join(F.slice(sentence, i, j - i + 1), " "))))
        told_first = F.when(F.exists(lines_, lambda x: x["opens"]), look_up(F.transform(before, told))).otherwise(F.array().cast("array<bigint>"))
        return F.when(n > 1, F.concat(told_first, alone, look_up(joined))).otherwise(alone)

    out = docs.withColumn(lines, normal_lines).withColumn(found, F.flatten(F.transform(F.filter(lines, lambda x: F.size(x) > 0), hits)))
    out = out.withColumn(made[0], F.transform(found, lambda h: name[h.cast("string")]))
    # The sequence as text, each identifier between blanks; a rule takes its own out.
    other = r"((?: [a-z0-9-]+ ){0,%d}?)" % gap
    told_rules = [{"licence": licence, "first": f" {order[0]} ", "pattern": other.join(f" {x} " for x in order), "kept": "".join(f"${k}" for k in range(1, len(order)))} for licence, order in rules]
    every = F.from_json(F.lit(json.dumps(told_rules)), "array<struct<licence: string, first: string, pattern: string, kept: string>>")
    sequence = F.concat(F.lit(" "), F.array_join(made[0], "  "), F.lit(" "))

    def taken(state: Column, rule: Column) -> Column:
        holds = F.contains(state["left"], rule["first"]) & F.rlike(state["left"], rule["pattern"])
        return F.when(holds, F.struct(F.regexp_replace(state["left"], rule["pattern"], rule["kept"]).alias("left"), F.concat(state["held"], F.array(rule["licence"])).alias("held"))).otherwise(state)

    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("held"))
    out = out.withColumn(state, F.when(F.size(made[0]) > 0, F.aggregate(every, start, taken)).otherwise(start))
    out = out.withColumn(made[1], F.array_distinct(F.col(state)["held"])).withColumn(made[2], F.array_remove(F.split(F.col(state)["left"], " +"), ""))
    return out.drop(lines, found, state)
