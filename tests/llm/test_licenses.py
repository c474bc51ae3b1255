"""License scans: token automata against naive matching, base places against SQL."""

import itertools
import random

import duckdb

from tests.llm.helpers import SF, clashing, docs, rows
from weir.llm import licenses


def expansions(items):
    """All token sequences of a template: words, or None for any word, each with the
    mandatory words matched so far; and the number of mandatory words."""
    def walk(i, depth):
        if i == len(items):
            return [[]]
        kind = items[i]
        if kind[0] == "word":
            return [[(kind[1], depth == 0)] + rest for rest in walk(i + 1, depth)]
        if kind[0] == "var":
            return [[(None, False)] * k + rest for k in range(kind[1], kind[2] + 1) for rest in walk(i + 1, depth)]
        if kind[0] == "open":
            end, level = i + 1, 1
            while level:
                level += (items[end][0] == "open") - (items[end][0] == "close")
                end += 1
            return walk(i + 1, depth + 1) + walk(end, depth)
        return walk(i + 1, depth - 1)
    return walk(0, 0), None


def naive(templates, words):
    found, best = set(), 0.0
    for name, markup in templates.items():
        seqs, _ = expansions(licenses.parse_template(markup))
        total = sum(must for _, must in seqs[0])
        for seq, at in itertools.product(seqs, range(len(words) + 1)):
            matched = n = 0
            for (w, must), x in zip(seq, words[at:]):
                if w is not None and w != x:
                    break
                matched += must
                n += 1
            best = max(best, matched / total)
            if n == len(seq):
                found.add(name)
    return found, best


SMALL = {
    "one": "a b <<beginOptional>>c <<beginOptional>>d<<endOptional>> e<<endOptional>> f",
    "two": "<<beginOptional>>x <<var;name=v;words=1-2>><<endOptional>> a <<var;name=w;words=0-2>> b b",
    "three": "a a b",
}


def test_random_words_against_naive_matching():
    rng = random.Random(6)
    t = licenses.Templates(SMALL)
    for _ in range(3000):
        words = [rng.choice("aabbcdefx").encode() for _ in range(rng.randint(0, 12))]
        found, best = t.scan(words)
        want, score = naive(SMALL, words)
        assert found == want and abs(best - score) < 1e-12, words


def test_real_templates_accept_their_own_wording_only():
    t = licenses.Templates(licenses.TEMPLATES)
    for name, markup in licenses.TEMPLATES.items():
        seqs, _ = expansions(licenses.parse_template(markup))
        for seq in (seqs[0], seqs[-1]):
            words = [b"before"] + [w or b"widget" for w, _ in seq] + [b"after"]
            found, score = t.scan(words)
            assert name in found and score == 1.0
            k = next(i for i, (w, must) in enumerate(seq) if must and i > 0)
            words[1 + k] = b"unrelated"
            assert name not in t.scan(words)[0]


def test_common_licenses_and_their_neighbours(spark):
    """Typical wordings get their label; a changed mandatory word loses it."""
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following "
           "conditions\nare met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
           "the following disclaimer.\n * Redistributions in binary form must reproduce the above copyright notice, this list of "
           "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n{}"
           "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, "
           "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")
    third = ("3. Neither the name of Example Corp. nor the names of its contributors may be used to endorse or promote products derived "
             "from this software without specific prior written permission.\n")
    texts = {
        bsd.format(third): "bsd-3-clause", bsd.format(""): "bsd-2-clause", bsd.format(third).replace("permission", "consent"): "",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.":
            "lgpl-or-later-notice",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free "
        "Software Foundation.": "gpl,gpl-2.0-only-notice",
        "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed "
        "with this\n// file, You can obtain one at https://mozilla.org/MPL/2.0/.": "mpl-2.0",
        "Licensed under CC BY-SA 4.0": "cc-by,cc-by-sa-4.0-notice", "Licensed under CC BY-ND 4.0": "cc-by,cc-by-nd-4.0-notice",
        "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n"
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.":
            "gpl,gpl-3.0-text",
        "This is free and unencumbered software released into the private domain.": "",
    }
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(docs(spark, list(texts))).collect()}
    for i, want in enumerate(texts.values()):
        assert got[i][0] == want and (got[i][1] == 1.0) == bool(want), (list(texts)[i], got[i])


def test_the_table_of_states_may_be_dropped(monkeypatch):
    rng = random.Random(6)
    words = [rng.choice("aabbcdefx").encode() for _ in range(400)]
    want = licenses.Templates(SMALL).scan(words)
    monkeypatch.setattr(licenses, "_STATES", 3)
    assert licenses.Templates(SMALL).scan(words) == want


BASE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) - 1 AS i FROM d),
l AS (SELECT *, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS e FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i, 'gpl' AS label FROM l WHERE a = 'gnu' AND b = 'general' AND c = 'public' AND e = 'license'
      UNION ALL SELECT doc_id, i, 'apache' FROM l WHERE a = 'apache' AND b = 'license'
      UNION ALL SELECT doc_id, i, 'cc-by' FROM l WHERE a = 'cc' AND b = 'by'
      UNION ALL SELECT doc_id, i, 'mit' FROM l WHERE a = 'mit' AND b = 'license')
SELECT d.doc_id, len(d.w) AS n_words, count(h.i) AS n_base, min(h.i) AS first_word, max(h.i) AS last_word,
       coalesce(string_agg(DISTINCT h.label, ',' ORDER BY h.label), '') AS base_labels
FROM d LEFT JOIN h USING (doc_id) GROUP BY d.doc_id, d.w
"""


def test_base_columns_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(BASE).fetchall(), key=repr)
    got = licenses.scan_licenses(spark.read.parquet(f"{SF}/documents.parquet"))
    assert rows(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == want


def test_documents_against_naive_matching(spark):
    got = licenses.scan_licenses(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    short = {n: m for n, m in licenses.TEMPLATES.items() if n.endswith("notice") and n != "gpl-or-later-notice"}
    for r in got:
        if r.n_words < 400:
            found, _ = naive(short, licenses.license_words((texts[r.doc_id] or "").encode()))
            assert found == {x for x in r.labels.split(",") if x in short}
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_awkward_rows(spark):
    texts = [None, "", "CC BY cc-by CC.BY.CC BY", "GNU general-public LICENSE", "the MIT Licence", "mit licenseé MIT license",
             "Licensed under the Apache License, Version 2.0.", "x " * 50000 + "mit license", "é" * 3]
    df = clashing(docs(spark, texts, ids=[1, 2, 3, 4, 5, 6, None, 8, 8]))
    got = {(r.doc_id, r.n_words): tuple(r)[2:] for r in licenses.scan_licenses(df).collect()}
    assert got[(1, 0)] == got[(2, 0)] == (0, None, None, "", "", 0.0)
    assert got[(3, 8)][:4] == (4, 0, 6, "cc-by")
    assert got[(4, 4)][:4] == (1, 0, 0, "gpl")
    assert got[(6, 4)][:4] == (1, 2, 2, "mit")
    assert got[(None, 8)] == (1, 3, 3, "apache", "apache,apache-2.0-notice", 1.0)
    assert got[(8, 50002)][:3] == (1, 50000, 50000)
    assert licenses.scan_licenses(docs(spark, [])).count() == 0
