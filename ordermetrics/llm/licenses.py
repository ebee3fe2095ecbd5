"""Licence scans: template texts with markup, matched as automata over words.

A template is plain wording with two kinds of regions: ``[[ ... ]]`` may be absent, and
``{n}`` stands for any one to n words. Outside of them every word has to match exactly. A
template compiles to an automaton whose states are places in its wording. A text is scanned
from every place where a template can begin; plain phrases are looked for at every place.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermetrics.llm import words as w

# Phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Whole texts from their first condition on; names of holders may be replaced.
_BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met [[1]] redistributions of source "
    "code must retain the above copyright notice this list of conditions and the following "
    "disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice "
    "this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution ")
_BSD_NAMES = (
    "[[3]] neither the name of {12} nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission ")
_BSD_WARRANTY = (
    "this software is provided by {12} as is and any express or implied warranties including "
    "but not limited to the implied warranties of merchantability and fitness for a particular "
    "purpose are disclaimed in no event shall {12} be liable for any direct indirect incidental "
    "special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however "
    "caused and on any theory of liability whether in contract strict liability or tort "
    "including negligence or otherwise arising in any way out of the use of this software even "
    "if advised of the possibility of such damage")

_GNU_HEADER = (
    "free software you can redistribute it and or modify it under the terms of the gnu {kind} "
    "public license as published by the free software foundation either version {{1}} [[{{1}}]] of "
    "the license or at your option any later version [[this program]] [[{{4}}]] is distributed in "
    "the hope that it will be useful but without any warranty without even the implied warranty "
    "of merchantability or fitness for a particular purpose see the gnu {kind} public license for "
    "more details [[you should have received a copy of the gnu {kind} public license along with "
    "{{4}} if not see {{6}}]]")

# Licence texts and notices as templates; labels name the one that matched as a whole.
TEMPLATES = {
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions the "
        "above copyright notice and this permission notice [[including the next paragraph]] "
        "shall be included in all copies or substantial portions of the software the software "
        "is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement in no event shall {12} be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in "
        "connection with the software or the use or other dealings in the software"),
    "bsd-2-clause-text": _BSD_CONDITIONS + _BSD_WARRANTY,
    "bsd-3-clause-text": _BSD_CONDITIONS + _BSD_NAMES + _BSD_WARRANTY,
    "isc-text": (
        "permission to use copy modify and [[or]] distribute this software for any purpose with "
        "or without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies the software is provided as is and {12} "
        "disclaims all warranties with regard to this software including all implied warranties "
        "of merchantability and fitness in no event shall {12} be liable for any special direct "
        "indirect or consequential damages or any damages whatsoever resulting from loss of use "
        "data or profits whether in an action of contract negligence or other tortious action "
        "arising out of or in connection with the use or performance of this software"),
    "zlib-text": (
        "this software is provided as is without any express or implied warranty in no event "
        "will {12} be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including "
        "commercial applications and to alter it and redistribute it freely subject to the "
        "following restrictions [[1]] the origin of this software must not be misrepresented "
        "you must not claim that you wrote the original software if you use this software in a "
        "product an acknowledgment in the product documentation would be appreciated but is not "
        "required [[2]] altered source versions must be plainly marked as such and must not be "
        "misrepresented as being the original software [[3]] this notice may not be removed or "
        "altered from any source distribution"),
    "unlicense-text": (
        "this is free and unencumbered software released into the public domain anyone is free "
        "to copy modify publish use compile sell or distribute this software either in source "
        "code form or as a compiled binary for any purpose commercial or non commercial and by "
        "any means in jurisdictions that recognize copyright laws the author or authors of this "
        "software dedicate any and all copyright interest in the software to the public domain "
        "we make this dedication for the benefit of the public at large and to the detriment of "
        "our heirs and successors we intend this dedication to be an overt act of relinquishment "
        "in perpetuity of all present and future rights to this software under copyright law the "
        "software is provided as is without warranty of any kind express or implied including "
        "but not limited to the warranties of merchantability fitness for a particular purpose "
        "and noninfringement in no event shall the authors be liable for any claim damages or "
        "other liability whether in an action of contract tort or otherwise arising from out of "
        "or in connection with the software or the use or other dealings in the software "
        "[[for more information please refer to {6}]]"),
    "bsl-1-text": (
        "permission is hereby granted free of charge to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license the "
        "software to use reproduce display distribute execute and transmit the software and to "
        "prepare derivative works of the software and to permit third parties to whom the "
        "software is furnished to do so all subject to the following the copyright notices in "
        "the software and this entire statement including the above license grant this "
        "restriction and the following disclaimer must be included in all copies of the software "
        "in whole or in part and all derivative works of the software unless such copies or "
        "derivative works are solely in the form of machine executable object code generated by "
        "a source language processor the software is provided as is without warranty of any kind "
        "express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose title and non infringement in no event shall the "
        "copyright holders or anyone distributing the software be liable for any damages or "
        "other liability whether in contract tort or otherwise arising from out of or in "
        "connection with the software or the use or other dealings in the software"),
    "apache-2-header": (
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at {8} "
        "unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied see the license for the specific language governing "
        "permissions and limitations under the license"),
    "gpl-header": _GNU_HEADER.format(kind="general"),
    "lgpl-header": _GNU_HEADER.format(kind="lesser general"),
    "agpl-header": _GNU_HEADER.format(kind="affero general"),
    "mpl-2-header": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
        "copy of the mpl was not distributed with this file you can obtain one at {8}"),
    "apache-notice": "licensed under the apache license [[version 2 0]] [[the license]]",
    "cc-by-notice": (
        "[[this work is]] licensed under [[a]] [[the]] [[creative commons attribution]] cc by "
        "[[sa]] [[nc]] [[nd]] [[{1} 0]] [[international]] [[license]]"),
    "gpl-notice": (
        "under the terms of the gnu general public license [[as published by the free software "
        "foundation]] [[version {1}]] [[or later]]"),
    "gpl-licensed": (
        "licensed under [[the terms of]] the gnu general public license [[version {1}]] "
        "[[or later]]"),
    "mit-notice": (
        "[[released]] [[licensed]] under the [[terms of the]] mit license"),
    "mit-permission": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction"),
    "copyright-line": "copyright [[c]] [[{1}]] {6} all rights reserved",
    "spdx-tag": "spdx license identifier {3}",
}


def compile_template(text: str) -> list[tuple]:
    """The automaton's states: (word or None, states after it); the last one accepts.

    A state reads one word, any word where it is None. States that may be left out are
    leapt over when the template is compiled.
    """
    tokens = re.findall(r"\[\[|\]\]|\{\d+\}|[^\s\[\]{}]+", text)
    steps, opened = [], []
    skips: dict[int, set[int]] = {}
    for token in tokens:
        if token == "[[":
            opened.append(len(steps))
        elif token == "]]":
            skips.setdefault(opened.pop(), set()).add(len(steps))
        elif token[0] == "{":
            many = int(token[1:-1])
            end = len(steps) + many
            for i in range(many):
                if i:
                    skips.setdefault(len(steps), set()).add(end)
                steps.append(None)
        else:
            steps.append(token)
    if opened:
        raise ValueError(f"a region of the template is not closed: {text!r}")

    def reach(state: int) -> tuple[int, ...]:
        seen, todo = set(), [state]
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo.extend(skips.get(at, ()))
        return tuple(sorted(seen))

    return [(step, reach(i + 1)) for i, step in enumerate(steps)] + [("", reach(0))]


def accepted(automaton: list[tuple], texts: list, at: int) -> int:
    """End of the longest match that begins at word ``at``, or -1."""
    final = len(automaton) - 1
    states, end = set(automaton[final][1]), -1
    while states:
        if final in states:
            end = at
        if at >= len(texts):
            break
        word = texts[at]
        states = {after for s in states if s < final
                  and (automaton[s][0] is None or automaton[s][0] == word)
                  for after in automaton[s][1]}
        at += 1
    return end


def _first_words(automaton: list[tuple]) -> set[str]:
    found = {automaton[s][0] for s in automaton[-1][1] if s < len(automaton) - 1}
    if None in found or len(automaton) - 1 in automaton[-1][1]:
        raise ValueError("a template has to begin with a word that must be there")
    return found


def _name(words_: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words_).encode(), np.uint8)
    start, end, _ = w.spans(data, np.array([0, len(data)]), w.ALNUM)
    return w.word_hashes(data, start, end)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """One row for each row of ``docs``: words, phrase places, labels, spans and score.

    Words are runs of lower-cased ASCII letters, digits and non-ASCII characters. Columns:
    doc_id, n_words, n_base (places where a phrase stands), first_word and last_word (their
    smallest and largest first word, null without any), base_labels, labels (with those of
    matching templates), spans (label, first word, end of each match), score: the share of
    the text's words that phrases and templates cover, 0 for a text without words. Null
    texts are empty; repeated rows and ids are rows of their own.
    """
    built = {label: compile_template(text) for label, text in templates.items()}
    begins: dict[int, list[str]] = {}
    for label, automaton in built.items():
        for word in _first_words(automaton):
            begins.setdefault(int(_name([word])[0]), []).append(label)
    wanted = np.sort(np.array(list(begins), np.uint64))
    names = [(label, _name(phrase.split())) for phrase, label in phrases.items()]
    # The automata read word hashes, so that no word is decoded before a template matches.
    hashed = {label: [(word and int(_name([word])[0]), after) for word, after in automaton]
              for label, automaton in built.items()}

    def row_of(hashes, text_at, count):
        base, spans = [], []
        for label, phrase in names:
            if len(hashes) >= len(phrase):
                hit = hashes[:len(hashes) - len(phrase) + 1] == phrase[0]
                places = np.flatnonzero(hit)
                for j in range(1, len(phrase)):
                    places = places[hashes[places + j] == phrase[j]]
                base += [(label, int(p), int(p) + len(phrase)) for p in places]
        for p in np.flatnonzero(np.isin(hashes, wanted)).tolist() if len(wanted) else ():
            for label in begins[int(hashes[p])]:
                end = accepted(hashed[label], hashes, p)
                if end > p and accepted(built[label], text_at(p, end), 0) == end - p:
                    spans.append((label, p, end))
        covered = np.zeros(count, bool)
        for _, a, b in base + spans:
            covered[a:b] = True
        places = [a for _, a, _ in base]
        return (count, len(base), min(places, default=None), max(places, default=None),
                ",".join(sorted({x for x, _, _ in base})),
                ",".join(sorted({x for x, _, _ in base + spans})),
                [{"label": x, "first": a, "end": b} for x, a, b in base + spans],
                float(covered.mean()) if count else 0.0)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
             pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()),
                                 ("end", pa.int64())])), pa.float64()]
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
               "spans", "score"]

    def run(batches):
        for batch in batches:
            for first, stop, data, offsets in w.slices(batch, text_col):
                data = w.LOWER[data]
                start, end, row = w.spans(data, offsets, w.ALNUM)
                hashes = w.word_hashes(data, start, end)
                bounds = w.row_bounds(row, stop - first)

                def texts(base):
                    return lambda a, b: [data[start[base + i]:end[base + i]].tobytes().decode()
                                         for i in range(a, b)]

                rows = [row_of(hashes[a:b], texts(a), int(b - a))
                        for a, b in zip(bounds[:-1], bounds[1:])]
                ids = batch.column(id_col).slice(first, stop - first).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], columns)

    return docs.select(id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
             "base_labels string, labels string, "
             "spans array<struct<label: string, first: bigint, end: bigint>>, score double")
