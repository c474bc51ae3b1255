"""Operator 10, license scans: template-markup matching.

Templates are written in the usual markup: ``<<beginOptional>>`` ...
``<<endOptional>>`` around wording that may be left out, ``<<var;name=...;words=a-b>>``
for a replaceable region of a to b words. Each is compiled into a token automaton
(one state per word of wording, one per word a region may still take, empty moves
around optional wording). All templates run together, restarted at every word, as one
automaton whose deterministic states are built when first met; the text's words are
streamed through once. A template is accepted where its mandatory wording stands
word for word. ``score`` is the largest share of a template's mandatory words
matched in order and without a gap up to some place: 1 exactly if one is accepted.

Words: A-Z lower-cased, then runs of digits, a-z and characters beyond ASCII.
Base: every place where a fixed phrase's words stand consecutively.

Defined cases: null text has no words, no labels (empty strings) and score 0; ties
of score keep the value; repeated rows give repeated rows; very long texts are
streamed in one pass with a bounded set of states; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from weir.llm.text import on_text, text_udf

#: Fixed phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_WORK = "<<beginOptional>>This <<var;name=work;words=1-6>> is<<endOptional>> "
_FSF = (" as published by the Free Software Foundation<<beginOptional>>, either version <<var;name=version;words=1-2>> of the "
        "License, or (at your option) any later version<<endOptional>>")
_MODIFY = "you can redistribute it and/or modify it under the terms of the GNU "
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. ")
_AS_IS = ("THIS SOFTWARE IS PROVIDED BY <<var;name=holder;words=1-8>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
          "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")
_VERBATIM = ("Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
             "allowed.")

#: Notices, short licenses and the heads of long ones, in template markup: fixed wording of
#: published licenses.
TEMPLATES = {
    "agpl-3.0-notice": _WORK + "licensed under the GNU Affero General Public License, version 3",
    "agpl-3.0-text": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright <<beginOptional>>(C)<<endOptional>> "
                     "2007 Free Software Foundation, Inc. <<var;name=link;words=0-4>> " + _VERBATIM,
    "agpl-or-later-notice": _MODIFY + "Affero General Public License" + _FSF,
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "<<var;name=scheme;words=1-1>>://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
                         "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2.0-notice": _WORK + "Licensed under the Apache License, Version 2.0",
    "apache-2.0-text": "Apache License Version 2.0, January 2004 <<var;name=link;words=0-5>> TERMS AND CONDITIONS FOR USE, "
                       "REPRODUCTION, AND DISTRIBUTION",
    "bsd-2-clause": _BSD + _AS_IS,
    "bsd-3-clause": _BSD + "<<beginOptional>>3.<<endOptional>> Neither the name of <<var;name=owner;words=1-8>> nor the names of its "
                    "contributors may be used to endorse or promote products derived from this software without specific prior "
                    "written permission. " + _AS_IS,
    "cc-by-4.0-notice": _WORK + "Licensed under <<beginOptional>>the<<endOptional>> CC BY 4.0",
    "cc-by-nc-4.0-notice": _WORK + "Licensed under <<beginOptional>>the<<endOptional>> CC BY-NC 4.0",
    "cc-by-nc-nd-4.0-notice": _WORK + "Licensed under <<beginOptional>>the<<endOptional>> CC BY-NC-ND 4.0",
    "cc-by-nc-sa-4.0-notice": _WORK + "Licensed under <<beginOptional>>the<<endOptional>> CC BY-NC-SA 4.0",
    "cc-by-nd-4.0-notice": _WORK + "Licensed under <<beginOptional>>the<<endOptional>> CC BY-ND 4.0",
    "cc-by-sa-4.0-notice": _WORK + "Licensed under <<beginOptional>>the<<endOptional>> CC BY-SA 4.0",
    "cc-by-sa-4.0-long-notice": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-4.0-long-notice": "licensed under a Creative Commons Attribution 4.0 International License",
    "cc0-1.0-notice": "To the extent possible under law, <<var;name=owner;words=1-6>> has waived all copyright and related or "
                      "neighboring rights to <<var;name=work;words=1-6>>",
    "gpl-2.0-notice": _WORK + "licensed under the GNU General Public License, version 2",
    "gpl-2.0-only-notice": _MODIFY + "General Public License version 2 as published by the Free Software Foundation",
    "gpl-2.0-text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright <<beginOptional>>(C)<<endOptional>> 1989, 1991 Free "
                    "Software Foundation, Inc.<<beginOptional>>,<<endOptional>> <<var;name=address;words=0-12>> " + _VERBATIM,
    "gpl-3.0-notice": _WORK + "licensed under the GNU General Public License, version 3",
    "gpl-3.0-text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright <<beginOptional>>(C)<<endOptional>> 2007 Free "
                    "Software Foundation, Inc. <<var;name=link;words=0-4>> " + _VERBATIM,
    "gpl-or-later-notice": "is free software<<beginOptional>>;<<endOptional>> " + _MODIFY + "General Public License" + _FSF,
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-or-later-notice": _MODIFY + "Lesser General Public License" + _FSF,
    "lgpl-text": "GNU LESSER GENERAL PUBLIC LICENSE Version <<var;name=version;words=1-6>> Copyright <<beginOptional>>(C)<<endOptional>> "
                 "<<var;name=years;words=1-2>> Free Software Foundation, Inc. <<var;name=address;words=0-12>> " + _VERBATIM,
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name=work;words=1-12>> to "
           "deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
           "is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
           "notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or "
           "substantial portions of the Software.",
    "mit-notice": _WORK + "Released under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
               "distributed with this file, You can obtain one at <<var;name=scheme;words=1-1>>://mozilla.org/MPL/2.0/",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                 "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                 "purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
            "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
            "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
            "following restrictions:",
}

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Deterministic states kept; beyond, the table starts anew (the result does not depend on it).
_STATES = 50_000


def license_words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def parse_template(markup: str) -> list[tuple]:
    """``("word", w) | ("open",) | ("close",) | ("var", least, most)`` items."""
    items: list[tuple] = []
    for part in re.split(r"(<<[^>]*>>)", markup):
        if part == "<<beginOptional>>":
            items.append(("open",))
        elif part == "<<endOptional>>":
            items.append(("close",))
        elif part.startswith("<<var"):
            least, most = re.search(r"words=(\d+)-(\d+)", part).groups()
            items.append(("var", int(least), int(most)))
        else:
            items += [("word", w) for w in license_words(part.encode())]
    return items


class Templates:
    """The union of all template automata, restarted at every word."""

    def __init__(self, templates: dict[str, str]):
        # A state: the moves by word, by any word, and without a word; matched mandatory words and their total.
        self.by_word: list[dict[bytes, int]] = []
        self.by_any: list[int | None] = []
        self.empty: list[list[int]] = []
        self.done: list[float] = []
        self.label: dict[int, str] = {}
        starts = [self._compile(name, parse_template(markup)) for name, markup in templates.items()]
        self.start = self._closed(starts)
        self.known = {w for m in self.by_word for w in m}
        self.moves: dict[tuple[frozenset, bytes | None], tuple] = {}
        self.first = self._facts(self.start)

    def _state(self) -> int:
        self.by_word.append({})
        self.by_any.append(None)
        self.empty.append([])
        self.done.append(0.0)
        return len(self.empty) - 1

    def _compile(self, name: str, items: list[tuple]) -> int:
        depth = total = 0
        for it in items:
            depth += (it[0] == "open") - (it[0] == "close")
            total += it[0] == "word" and depth == 0
        start = at = self._state()
        opened, matched = [], 0
        for it in items:
            to = self._state()
            if it[0] == "word":
                self.by_word[at][it[1]] = to
                matched += not opened
            elif it[0] == "open":
                self.empty[at].append(to)
                opened.append(at)
            elif it[0] == "close":
                self.empty[at].append(to)
                self.empty[opened.pop()].append(to)
            else:
                for k in range(it[2]):
                    if k >= it[1]:
                        self.empty[at].append(to)
                    nxt = to if k == it[2] - 1 else self._state()
                    self.by_any[at] = nxt
                    self.done[nxt] = matched / total
                    at = nxt
            self.done[to] = matched / total
            at = to
        self.label[at] = name
        return start

    def _closed(self, states) -> frozenset:
        todo, out = list(states), set()
        while todo:
            s = todo.pop()
            if s not in out:
                out.add(s)
                todo += self.empty[s]
        return frozenset(out)

    def _facts(self, states: frozenset) -> tuple:
        return states, max(self.done[s] for s in states), tuple(sorted(self.label[s] for s in states if s in self.label))

    def _move(self, states: frozenset, word: bytes | None) -> tuple:
        to = {self.by_word[s][word] for s in states if word in self.by_word[s]}
        to |= {self.by_any[s] for s in states if self.by_any[s] is not None}
        return self._facts(self._closed(to) | self.start)

    def scan(self, words: list[bytes]) -> tuple[set[str], float]:
        """Labels of the templates accepted anywhere, and the score."""
        found: set[str] = set()
        best, known, moves = 0.0, self.known, self.moves
        at = start = self.first
        for w in words:
            if w not in known:
                if at is start:
                    continue
                w = None
            key = (at[0], w)
            to = moves.get(key)
            if to is None:
                if len(moves) >= _STATES:
                    moves.clear()
                to = self._move(at[0], w)
                if to[0] == start[0]:
                    to = start
                moves[key] = to
            at = to
            if at is not start:
                if at[1] > best:
                    best = at[1]
                if at[2]:
                    found.update(at[2])
        return found, best


def base_places(words: list[bytes]) -> tuple[list[int], set[str]]:
    """First words of every place of a phrase, and the labels found."""
    joined = b" " + b" ".join(words) + b" "
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        want = b" " + phrase.encode() + b" "
        at = joined.find(want)
        while at >= 0:
            places.append(joined.count(b" ", 0, at))
            labels.add(label)
            at = joined.find(want, at + 1)
    return places, labels


def _scan_batch(templates: dict[str, str]):
    built: list[Templates] = []

    def batch(texts):
        if not built:
            built.append(Templates(templates))
        out = []
        for text in texts:
            words = license_words(text)
            places, base = base_places(words)
            own, score = built[0].scan(words)
            out.append((len(words), len(places), min(places, default=None), max(places, default=None),
                        ",".join(sorted(base)), ",".join(sorted(base | own)), score))
        return out
    return batch


def scan_licenses(df: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of each row."""
    udf = text_udf("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
                   "score double", _scan_batch(templates or TEMPLATES))
    return on_text(df, udf, [id_col], text_col)
