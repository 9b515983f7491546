import hashlib
import math
import random
import re
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrixloom.llm import language, licences, pii, quality, queries, topk
from tests.oracle import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert_same(spark, SF, queries.queries()[name], queries.oracle_sql()[name])


# --- Licences


HEADERS = {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MIT": 'MIT License\n\nCopyright (c) 2020 Some One\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "BSD-2-Clause": "Copyright (c) 2020, Some One\n\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "CC-BY-SA-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSL-1.0": "SPDX-License-Identifier: BSL-1.0",
}
HEADERS["BSD-3-Clause"] = HEADERS["BSD-2-Clause"] + "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."


def wrapped(text, width, mark):
    return "\n".join(mark + line for part in text.split("\n\n") for line in [*textwrap.wrap(part.strip(), width), ""])


def test_standard_licences_joined_and_wrapped(spark):
    shapes = [(None, ""), (78, ""), (60, "# "), (40, " * "), (90, "// ")]
    docs = [(name, f"Some words before\n{wrapped(text, w, m) if w else text}\n\nint main() {{ return 0; }}\nand after") for name, text in HEADERS.items() for w, m in shapes]
    found = licences.recognised(spark.createDataFrame(docs, "want string, text string")).collect()
    assert [(r.want, r.licences) for r in found if r.licences != [r.want]] == []


def brute_told(s):
    s = re.sub(licences.SPDX, "spdx ", re.sub(licences.NOTICE, "notice ", s))
    s = re.sub(licences.TAIL, r"\1", s) if s.startswith("notice ") else s
    for slot, filled in licences.SLOTS:
        s = re.sub(slot, filled.replace("$1", r"\1"), s)
    return s


def brute_entries(s):
    if s.startswith("spdx "):
        return ["notice " + x for x in re.split(licences.BETWEEN, s[5:])]
    parts = re.split(licences.OR, s[7:]) if s.startswith("notice ") else []
    return [s] + ["notice " + x for x in parts if len(parts) > 1]


def brute_licences(text, gap=5):
    """Sentences and rules by plain loops."""
    told = brute_told
    mark = r"^[^\w(]*\(?(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})\)\s+"
    spelt = lambda s: re.sub(mark, "", s.lower()).replace("+", " or later ").replace("licence", "license")
    plain = lambda s: told(" ".join(re.sub(r"(?<![0-9])\.|\.(?![0-9])|[^\w.]+|_", " ", spelt(s)).split()))
    known = {plain(t): n for n, ts in licences.known_sentences().items() for t in ts}
    ids = []
    for sentence in re.split(r"(?i)(?<!\binc)(?<!\bltd)(?<!\bcorp)(?<!\bco)(?<!\bjr)(?<!\bdr)[.!?;]+(?=\s|$)|\r?\n[^\w\n]*\r?\n", text or ""):
        raw = [x for x in re.split(r"[\r\n]+", sentence) if plain(x)]
        lines = list(map(plain, raw))
        opened = [told(" ".join(lines[i : j + 1])) for j in range(1, len(lines) - 1) if re.search(r":\s*$", raw[j]) for i in range(j)]
        for said in (opened, lines, [told(" ".join(lines[i:])) for i in range(len(lines) - 1)]):
            ids += [known[x] for s in said for x in brute_entries(s) if x in known]
    told = list(ids)
    licence = []
    for name, order in licences.RULES:
        a = 0
        while a < len(ids):
            at, taken = a, []
            for n, want in enumerate(order):
                stop = at + 1 if n == 0 else at + gap + 1
                hit = next((i for i in range(at, min(stop, len(ids))) if ids[i] == want), None)
                if hit is None:
                    break
                taken.append(hit)
                at = hit + 1
            if len(taken) == len(order):
                licence.append(name)
                ids = [x for i, x in enumerate(ids) if i not in taken]
                a = taken[-1] + 1 - len(taken)
            else:
                a += 1
    return told, list(dict.fromkeys(licence)), ids


def test_licences_match_brute_force(spark):
    rng = random.Random(13)
    pool = [*licences.SENTENCES.values(), *HEADERS.values(), "Released under the MIT License", "SPDX-License-Identifier: (GPL-2.0+ OR MIT) AND BSD-3-Clause WITH x-exception", "Dual licensed under either of Apache License, Version 2.0 or the MIT licence at your option.", "(a) Neither the name of Some Corp. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "Some other words here.", "Licensed under CC BY-NC 4.0.", "All rights reserved."]
    docs = [(i, rng.choice([" ", "\n", "\n\n"]).join(textwrap.fill(rng.choice(pool), rng.choice([50, 10**6])) for _ in range(rng.randint(0, 9)))) for i in range(200)]
    docs += [(900, None), (901, ""), (902, "line without an end\n" * 3000 + "released under the MIT License."), (903, "word " * 60000)]
    df = spark.createDataFrame(docs, "doc_id int, text string").withColumn("found_sentences", F.lit(1)).withColumn("rules_so_far", F.lit(2))
    got = {r.doc_id: (r.licence_sentences, r.licences, r.unmatched) for r in licences.recognised(df).collect()}
    for i, t in docs:
        assert got[i] == brute_licences(t), (i, t)
    assert licences.recognised(df.limit(0)).count() == 0


AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'


def bsd(a, b, *more):
    return "\n".join(["Copyright (c) 1999, Some One", "All rights reserved.", "", "Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions are met:", f"{a} Redistributions of source code must retain the above copyright", "   notice, this list of conditions and the following disclaimer.", f"{b} Redistributions in binary form must reproduce the above copyright notice,", "   this list of conditions and the following disclaimer in the", "   documentation and/or other materials provided with the distribution.", *more, "", AS_IS])


GNU = "{what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version."
PROBES = [
    (bsd("(a)", "(b)"), ["BSD-2-Clause"]),
    (bsd("  i)", " ii)"), ["BSD-2-Clause"]),
    (bsd("*", "*", "* Neither the name of Google Inc. nor the names of its", "contributors may be used to endorse or promote products derived from", "this software without specific prior written permission."), ["BSD-3-Clause"]),
    (bsd("1.", "2.", "3. The name of Some Other Person may not be used to endorse or promote products derived from this software without specific prior written permission."), ["BSD-3-Clause"]),
    (bsd("1.", "2.", "3. All advertising materials mentioning features or use of this software must display the following acknowledgment: This product includes software developed by the University of X and others.", "4. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."), ["BSD-4-Clause"]),
    (GNU.format(what="This library", name="Library General Public License", v=2), ["LGPL-2.0-or-later"]),
    ("// SPDX-License-Identifier: Apache-2.0 OR MIT\nint x;", ["MIT", "Apache-2.0"]),
    ("# SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) AND BSD-3-Clause", ["BSD-3-Clause", "GPL-2.0-or-later"]),
    ("/* SPDX-License-Identifier: GPL-2.0+ */", ["GPL-2.0-or-later"]),
    ("This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"]),
    ("This project is licensed under the terms of the GNU General Public License v3.0 or later (see COPYING).", ["GPL-3.0-or-later"]),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["MIT", "Apache-2.0"]),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.,\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n", ["GPL-2.0-only"]),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\nHow to Apply These Terms\n\n" + GNU.format(what="This program", name="General Public License", v=2), ["GPL-2.0-only"]),
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n", ["Apache-2.0"]),
    ("           DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\n                   Version 2, December 2004\n\n Everyone is permitted to copy and distribute verbatim or modified\n copies of this license document, and changing it is allowed as long\n as the name is changed.\n\n            DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\n   TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n\n  0. You just DO WHAT THE FUCK YOU WANT TO.\n", ["WTFPL"]),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license (the \"Software\") to use, reproduce, display, distribute,\nexecute, and transmit the Software, and to prepare derivative works of the\nSoftware, and to permit third-parties to whom the Software is furnished to\ndo so, all subject to the following:\n", ["BSL-1.0"]),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS.\n", ["0BSD"]),
    ("We met under the old bridge. The name of the game is chess, and (a) nobody wins.", []),
    ("I wrote about the MIT License or the BSD one, but this text has neither.", []),
]


def test_slots_marks_expressions_and_titles(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PROBES)], "i int, text string")
    got = {r.i: [x for x in r.licences if x != "Proprietary"] for r in licences.recognised(df).collect()}
    assert [(PROBES[i][0], x) for i, x in got.items() if sorted(x) != sorted(PROBES[i][1])] == []


def test_licences_of_the_given_documents(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    found = licences.recognised(docs)
    lines = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3."}
    for name, line in lines.items():
        assert found.filter(F.array_contains("licences", name) != F.col("text").contains(line)).count() == 0


# --- Language


def test_language_accuracy_and_inputs(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    model = language.fit(docs)
    found = language.predict(docs.withColumnsRenamed({"lang": "row"}), model)
    joined = found.join(docs, "doc_id").filter(language.held_out(F.col("doc_id")))
    assert joined.filter("lang = lang_pred").count() >= 0.97 * joined.count()
    assert found.filter("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("12 %", None), ("", "de"), ("unddieder", None), ("Σ", None)] * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(df, language.fit(df)).collect()}
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert got[0][0] == "en" and got[1][0] == "de" and got[5][0] == "de" and got[6][0] in ("en", "de")
    nothing = language.fit(df.limit(0))
    assert {r.lang_pred for r in language.predict(df, nothing).collect()} == {"und"}
    assert language.predict(df.limit(0), nothing).count() == 0


def brute_language(docs, text, longest=4):
    """Prediction from counts in plain dictionaries; all rows that are not held out are learned."""
    learned = [(t, g) for i, t, g in docs if None not in (i, t, g) and zlib.crc32(str(i).encode()) % 5]
    names = [g for g, _ in sorted(Counter(g for _, g in learned).items(), key=lambda x: (-x[1], x[0]))]
    pieces = lambda w: [w[i : i + n] for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    words = {g: Counter(w for t, h in learned if h == g for w in language.WORD.findall(t.lower())) for g in names}
    grams = {g: Counter(x for w, n in words[g].items() for x in pieces(f"<{w}>") * n) for g in names}

    def scores(counts):
        terms = [x for x, n in sum(counts.values(), Counter()).items() if n >= 2]
        rows = {x: np.array([math.log((counts[g][x] + 0.5) / (counts[g].total() + 0.5 * max(1, len(terms)))) for g in names]) for x in terms}
        return {x: r - r.mean() for x, r in rows.items()}

    by_word, by_gram = scores(words), scores(grams)
    found = language.WORD.findall((text or "").lower())
    if not found:
        return "und", 0.0
    total = np.zeros(len(names))
    for w in found:
        if w in by_word:
            total += by_word[w]
            continue
        p, hits = f"<{w}>", []
        for i in range(len(p)):
            hits += [by_gram[p[i : i + n]] for n in range(longest, 0, -1) if p[i : i + n] in by_gram][:1]
        total += sum(hits) / len(hits) if hits else 0
    share = np.exp(total / len(found) - (total / len(found)).max())
    return names[int(share.argmax())], float(share.max() / share.sum())


def test_language_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(language, "CACHE_WORDS", 8)  # the cache starts anew within and between texts
    rng = random.Random(11)
    make = {g: [f"{rng.choice(a)}{rng.choice(b)}{rng.choice(a)}" for _ in range(25)] for g, a, b in (("aa", ["ka", "to", "ri"], ["n", "ss"]), ("bb", ["ze", "ul", "ri"], ["th", "n"]), ("cc", ["ka", "ul"], ["n", "x"]))}
    docs = []
    for i in range(120):
        g = rng.choice(["aa", "aa", "bb", "cc"])
        t = " ".join(rng.choice(make[g]) + rng.choice(["", "", "q", str(i), " kq"]) for _ in range(rng.randint(1, 30)))
        docs.append((i, t, rng.choice([g, g, g, None])))
    docs += [(200, "kann " * 4000 + "w" * 5000, None), (201, "x" * 100000, "bb"), (202, docs[0][1], None), (202, docs[0][1], None), (203, None, None), (None, "kan ri", "aa")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language.fit(df, sample=10**6)
    scorer = language.Scorer(model)  # in this process, so with the small cache
    for i, t, _ in docs:
        (lang, score), (want, share) = scorer.score(t), brute_language(docs, t)
        assert lang == want and abs(score - share) < 1e-9
    for r in language.predict(df, model).collect():
        texts = {scorer.score(t)[0] for i, t, _ in docs if i == r.doc_id}
        assert r.lang_pred in texts


def test_every_language_can_be_predicted(spark):
    rows = [(10 * i + j, f"w{chr(97 + i % 26)}{chr(97 + i // 26)}u " * 5, f"l{i:03d}") for i in range(90) for j in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predict(df.select("doc_id", "text"), language.fit(df)).join(df, "doc_id")
    assert found.filter("lang = lang_pred").count() == len(rows)


# --- Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    d = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 12 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def brute_spans(text):
    spans = [(m.start(), k, m.end()) for k, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], text or "") if holds(kind, m[0])]
    return ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_base_spans_match_brute_force(spark):
    rng = random.Random(5)
    parts = ["1", "12", "255", "300", "4111111111111111", "+1", "+", "(", ".", " ", "-", "@", "a", "b.c", "a@b.c", "%", "_", "é", "1.2.3.4", "😀", "00", "x@y.z_w@q.r", "\n"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(1500)]
    docs += [(9000, None), (9001, ""), (9002, "1" * 50000), (9003, "a.b" * 20000 + "@"), (9004, "1 " * 20000), (9005, "a@b" + ".c" * 20000), (9006, "+1" * 5000), (9007, "1." * 20000), (9008, "a@b.c " * 20000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("base", F.lit("clash"))
    got = {r.doc_id: r.s for r in pii.detected(df).select("doc_id", pii.listed(F.col("base")).alias("s")).collect()}
    assert {i: s for i, s in got.items() if s != brute_spans(dict(docs)[i])} == {}


def brute_added(docs, generalise=0.8, remove=0.95, chance=0.01):
    """Added spans from whole counts over the distinct texts."""
    texts = {t or "" for _, t in docs}
    email = re.compile(PATTERNS["email"], re.A)
    kinds = list(PATTERNS)

    def values(t):
        out = set()
        for kind, pattern in PATTERNS.items():
            for m in re.finditer(pattern, t):
                if holds(kind, m[0]):
                    out.add((kind, m[0].lower() if kinds.index(kind) < 2 else re.sub("[^0-9]", "", m[0])))
        return out

    word = re.compile(r"[^\W\d_]{3,}")
    has = {t: (values(t), {w.lower() for w in word.findall(email.sub(" ", t))}) for t in texts}
    n = len(texts)
    e, t_, k = Counter(), Counter(), Counter()
    for vs, ws in has.values():
        e.update(vs)
        t_.update(ws)
    for vs, ws in has.values():
        k.update((v, w) for v in vs for w in ws if e[v] > 1 and 1 < t_[w] <= e[v] * (n / e[v]) ** (1 - generalise) + 1e-6)
    share = {}
    for (v, w), x in k.items():
        m = e[v] * t_[w] / n
        if x > 1 and x * (math.log(x / m) - 1) >= math.log(len(k) / chance) and n > e[v]:
            share[v, w] = math.log2(x / m) / math.log2(n / e[v])
    def safe(v, prefix):
        held = [t for t in texts if any(w.startswith(prefix) for w in has[t][1])]
        joint = sum(v in has[t][0] for t in held)
        return n > e[v] and math.log2(joint * n / (e[v] * len(held))) / math.log2(n / e[v]) < generalise

    out = {}
    for i, t in docs:
        vs, ws = has[t or ""]
        letters = {}
        for w in ws:
            told = [v for v in vs if share.get((v, w), 0) >= generalise]
            if told:
                fits = [m for m in (3, 2, 1) if all(share[v, w] < remove and safe(v, w[:m]) for v in told)]
                letters[w] = fits[0] if fits else 0
        taken = [m.span() for m in email.finditer(t or "")]
        spans = [(m.start(), m.end(), m[0].lower()) for m in word.finditer(t or "") if not any(a < m.end() and m.start() < b for a, b in taken)]
        out[i] = sorted((a, "generalise" if letters[w] else "remove", b, w[: letters[w]]) for a, b, w in spans if w in letters)
    return out


def test_added_spans_match_brute_force(spark):
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "Su") for b in ("ru", "ta", "se", "éo") for c in ("ne", "po", "x")]
    filler = lambda n=30: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, f"{filler()} Zorblatt boss@corp.example.com {filler(60)} ZORBLATT") for i in range(6)] + [(10 + i, filler()) for i in range(240)]
    docs += [(300 + i, f"{filler()} {'Semi' if i % 5 else 'semi'}word {filler()}" + " 10.0.0.1" * (i < 12)) for i in range(18)]
    docs += [(500 + i, "copied Quuxword line near twin@corp.example.com and more") for i in range(9)]
    # Of 12 texts with "Miranda" 9 hold the address; many have words in "mir", as the filler has.
    docs += [(700 + i, f"{filler()} Miranda {filler()}" + " seldom@corp.example.com" * (i < 9)) for i in range(12)] + [(720, f"{filler()} Mirth")]
    # "Quillon" shares its first letter with "Quuxword", and nothing that stands often enough.
    docs += [(740 + i, f"{filler()} Quillon {filler()}" + " rarely@corp.example.com" * (i < 9)) for i in range(12)]
    # No other word begins with "lox", some with "lo".
    docs += [(760 + i, f"{filler()} Loxley {filler()}" + " hidden@corp.example.com" * (i < 9)) for i in range(12)]
    docs += [(600, None), (601, ""), (602, docs[0][1]), (602, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("base", F.lit(1)).withColumn("weight", F.lit(2)).repartition(3)
    want = brute_added(docs)
    got = {r.doc_id: [(x.s, pii.NAMES[x.k], x.e, x.kept) for x in r.every if x.k >= 4] for r in pii.detected(df).collect()}
    assert got == want
    assert {docs[0][1][a:b] for a, _, b, _ in want[0]} == {"Zorblatt", "ZORBLATT"} and not want[500] and any(want[i] for i in range(300, 312)) and not any(want[i] for i in range(312, 318))
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert "Zorblatt" not in clean[0] and "ZORBLATT" not in clean[0] and "boss@" not in clean[0] and "[EMAIL]" in clean[0]
    assert [(k, c) for _, k, _, c in want[700]] == [("generalise", "mir")] and " [mir*] " in clean[700] and "Miranda" not in clean[700] and "Miranda" in clean[709]
    assert [(k, c) for _, k, _, c in want[760]] == [("generalise", "lo")] and " [lo*] " in clean[760]
    assert [k for _, k, _, _ in want[740]] == ["remove"] and "Quillon" not in clean[740]
    assert clean[10] == dict(docs)[10] and clean[500] == "copied Quuxword line near [EMAIL] and more"


def brute_sanitised(text, spans):
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"][k]]
        at = max(at, e)
    return "".join([*out, text[at:]])


def test_sanitised_matches_brute_force_and_is_linear(spark):
    rng = random.Random(12)
    parts = ["a@b.cd", "1.2.3.4", "4111111111111111", "+1 555 0100 234", " ", "é😀 ", "word ", "\n", "+", "1.2.3.4111111111111111", "x" * 70]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs += [(1000, "é x@y.zz " * 700), (1001, "user@host.org " * 40000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert time.time() - began < 60  # 40,000 matches took over 40 s when arrays were copied for each
    for i, t in docs:
        spans = sorted((m.start(), k, m.end()) for k, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], t) if holds(kind, m[0]))
        assert got[i] == brute_sanitised(t, spans)


def test_sanitised_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 7), (None, "mail a@b.cd 1.2.3.4", 8), (1, "", 9), (1, "", 9)], "doc_id long, text string, body int")
    got = sorted(((r.text, r.body) for r in pii.sanitised(df).collect()), key=repr)
    assert got == sorted([(None, 7), ("mail [EMAIL] [IP]", 8), ("", 9), ("", 9)], key=repr)
    assert pii.sanitised(df.limit(0)).count() == 0


# --- Top-k


def brute_top(ids, vectors, every, k):
    x = np.floor(256 * vectors.astype(float)).astype(int)
    out = []
    for i, q in zip(ids, x):
        if i % every == 0:
            best = sorted((-int(q @ v), j) for j, v in zip(ids, x) if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def test_top_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    vectors = np.concatenate([rng.normal(size=(150, 16)) * 0.2 + rng.normal(size=16), rng.normal(size=(250, 16)) * 0.3, np.ones((5, 16))]).astype(np.float32)
    ids = list(range(3, 3 + len(vectors)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    for block in (8192, 100):
        monkeypatch.setattr(topk, "BLOCK", block)
        monkeypatch.setattr(topk, "QUERIES", 10)
        got = topk.top(df, 20).collect()
        assert sorted((r.query_id, r.rank, r.id, r.score) for r in got) == brute_top(ids, vectors, 20, 5)


def test_index_stops_early_and_keeps_the_best():
    rng = np.random.default_rng(8)
    v = np.floor(256 * (rng.normal(size=(2000, 8)) * np.array([3, 2, 1, 1, 0.1, 0.1, 0.1, 0.1]))).astype(np.int64)
    index = topk.Index(np.arange(2000), v, 8)
    for q in v[:20]:
        rows = index.possible(q, 5, np.array([], int))
        assert len(rows) < 1000
        assert set(np.lexsort((np.arange(2000), -(v @ q)))[:5]) <= set(rows.tolist())


def test_top_of_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [1.0]), (6, []), (20, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.id, r.score) for r in topk.top(df, 20).collect())
    one = 256 * 256
    assert got == [(0, 1, 20, 2 * one), (0, 2, 5, one), (0, 3, 6, 0), (20, 1, 0, 2 * one), (20, 2, 5, 2 * one), (20, 3, 6, 0)]
    assert topk.top(df.limit(0), 20).count() == 0


def test_top_of_repeated_rows_and_large_components(spark):
    rows = [(0, [1.0, 0.0])] * 2 + [(1, [9.0, 0.0])] * 5 + [(2, [8.0, 0.0])] + [(i, [0.001 * i, 0.0]) for i in range(3, 19)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.rank, r.id) for r in topk.top(df, 20).collect())
    assert got == [(k, 1) for k in range(1, 6)]
    got = sorted((r.rank, r.id) for r in topk.top(df, 20, k=7).collect())
    assert got == [(k, 1) for k in range(1, 6)] + [(6, 2), (7, 16)]  # 16, 17 and 18 are equal after scaling
    # 2**40 and one more after scaling: a product that doubles would round.
    rows = [(0, [1.0, 1.0]), (1, [2.0**32, 0.0]), (2, [2.0**32 + 2.0**-8, 0.0]), (3, [-(2.0**32), 0.0]), (4, [0.5, 0.0]), (20, [-(2.0**13), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.id, r.score) for r in topk.top(df, 20, k=6).collect())
    a = 256 * (2**40 + 1)
    assert got[:5] == [(0, 1, 2, a), (0, 2, 1, a - 256), (0, 3, 4, 128 * 256), (0, 4, 20, 256 * (256 - 2**21)), (0, 5, 3, -(2**48))]
    assert got[5] == (20, 1, 3, 2**61)


def test_top_of_components_that_overflow(spark):
    """A component may be too large for a double once scaled, and a score too large for a long, unless it is among the best."""
    rows = [(0, [1.0, 0.0])] + [(i, [0.5, 0.0]) for i in range(1, 6)] + [(6, [-1e306, 1.0]), (7, [0.0, 1e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.id, r.score) for r in topk.top(df, 20).collect())
    assert got == [(0, k, k, 256 * 128) for k in range(1, 6)]
    got = sorted((r.query_id, r.rank, r.id, r.score) for r in topk.top(df, 20, k=6).collect())
    assert got[5] == (0, 6, 7, 0)
    with pytest.raises(Exception, match="no long"):
        topk.top(df, 20, k=7).collect()


# --- Quality


def test_line_frequency(spark):
    letters = str.maketrans("0123456789", "ghijklmnop")  # digits are all alike in a normalised line
    own = lambda i: " ".join(f"{hex(i).translate(letters)}x{j}" for j in range(90))
    bar = "Menu  Home 7 About " + " ".join(f"m{j}" for j in range(70))
    docs = [(i, f"{own(i)}\n{bar}", "h") for i in range(40)] + [(100 + i, f"k{i}\n{bar}", "h") for i in range(3)]
    docs += [(200 + i, own(999), "h") for i in range(60)] + [(300, f"{own(5000)}\n{bar}", None), (310, "long " * 60000, "h"), (301, None, "h"), (302, "", "h"), (303, own(1) * 2, "h")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("hash_of_row", F.lit(1))
    got = {r.doc_id: r for r in quality.judged(df, most=20).collect()}
    assert all(got[i].kept and got[i].n_line_words_removed == 74 for i in range(40))
    assert all(not got[100 + i].kept and not got[100 + i].base_failed for i in range(3))
    assert all(got[200 + i].kept for i in range(60))  # copies of a text are one document
    assert got[300].kept and got[301].base_failed and got[302].base_failed
    hosts = [(400 + i, f"{own(400 + i)}\n{bar}", None if i % 2 else "") for i in range(26)]
    for most, n in ((12, 74), (13, 0)):  # null and empty are two hosts of 13 documents each
        apart = quality.judged(spark.createDataFrame(hosts, "doc_id long, text string, source string"), most=most)
        assert {r.n_line_words_removed for r in apart.collect()} == {n}
    clean = {r.doc_id: r.text for r in quality.cleaned(df, most=20).collect()}
    assert clean[0] == own(0) and clean[300].endswith(bar) and clean[301] is None
    assert quality.judged(df.limit(0)).count() == 0


def brute_repeated(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    t = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    return len({j for i, x in enumerate(t) if t.count(x) > 1 for j in (i, i + 1, i + 2)})


def test_repeated_words(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality.counted(df)[0].collect()}
    assert got == {i: brute_repeated(t) for i, t in docs}


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "123 %%", "en", "s", 6), (9004, "call +1 (555) 555-0100 now please friend", "en", "s", 40)], docs.schema)
    now, names = docs.unionByName(odd), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, SF), "test")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == names
        if name == "language identification":
            assert now.filter("doc_id in (9001, 9002, 9003)").count() == 0
        if name == "personal data":
            assert "[PHONE]" in now.filter("doc_id = 9004").first().text
    assert now.select("doc_id").distinct().count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stored(stage(spark, empty, SF), "test")
    assert empty.count() == 0


def test_pipeline_stages_of_odd_rows(spark):
    import corpus_pipeline

    text = "the cat and the dog are here with me today and " * 3 + "one"
    rows = [(1, text, "en", "h", 1), (1, text, "en", "h", 1), (None, text, "en", "h", 1), (2, None, "en", "h", 1), (3, None, None, None, None), (4, "", "de", "h", 0), (5, "12 %", "de", "h", 0), (6, text, "en", "g", 1), (7, "mail bob@x.org or else", "en", "g", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {name: stage(spark, docs, "").collect() for name, stage in corpus_pipeline.STAGES}
    ids = {name: sorted((r.doc_id or 0) for r in found) for name, found in out.items()}
    every = [0, 0, 1, 1, 2, 3, 4, 5, 6, 7]
    assert ids == {"language identification": [0, 1, 1, 6, 7], "near-duplicate removal": [0, 0, 1, 1, 2, 5, 7], "repeated-passage removal": every, "personal data": every, "packing": every}
    cut = {(r.doc_id, r.source): (r.text, r.n_chars) for r in out["repeated-passage removal"]}
    assert cut[2, "h"] == (None, None) and cut[4, "h"] == ("", 0) and cut[6, "g"] == ("", 0) and cut[1, "h"] == cut[None, "h"] == (text, len(text))
    told = {r.doc_id: r.text for r in out["personal data"]}
    assert told[2] is None and told[4] == "" and told[7] == "mail [EMAIL] or else"
    assert {r.doc_id: r.length for r in out["packing"] if r.doc_id in (2, 3, 4)} == {2: 1, 3: 1, 4: 1}
