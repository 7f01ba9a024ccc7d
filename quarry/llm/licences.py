"""Licence scans with a positional index of rare licence words.

Templates are licence notices and bodies as word sequences; each names mandatory key
phrases. Document frequencies of all template words are counted over all documents, so a
word's IDF says how telling it is in this corpus. Of each key phrase the ``ANCHORS``
positions of highest IDF go into the postings: word -> (phrase, position in the template).

A file's licence words are looked up from the highest IDF down. The rarest word of a phrase
proposes starts of the template (position in the file less position in the template); the
postings of its next word, at the same relative position, must agree, or the start is
dropped. The key phrase is then verified word by word. A place where a phrase stands has all
its words at their relative positions, so no place is missed. A template of several key
phrases needs all of them, each at a start at most ``SLACK`` words from the first one's
(names and years put in shift what follows). The score of a match is the share of the
template's words that stand at their relative position from any of these starts; templates
whose key phrase stands in other licences too ask for a least share. A file without any
proposing word is passed by after one set test.

Both passes are maps over Arrow batches; only the counts of template words (a fixed, small
vocabulary) are shuffled. Results by case: a null text has no words; places may overlap and
each counts; labels are distinct and sorted; repeated rows each get their row; an empty
table gives no rows.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.words import alnum

#: Least share of a template's words at their relative positions, for templates whose key
#: phrase other licences have too.
LEAST_SHARE = 0.6
#: Positions of a key phrase in the postings; words that a later key phrase may be shifted by.
ANCHORS, SLACK = 2, 24


@dataclass(frozen=True)
class Template:
    """A notice, its label and the phrases without which it isn't that licence."""

    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[bytes, ...], ...]
    base: bool = False
    least: float = 0.0


def template(label: str, notice: str, *phrases: str, base: bool = False, least: float = 0.0) -> Template:
    cut = lambda s: tuple(alnum(s.encode()))
    return Template(label, cut(notice), tuple(cut(p) for p in phrases or (notice,)), base, least)


#: The phrases of the contract: fixed values.
BASE = [
    template("mit", "under the mit license", base=True),
    template("apache-2", "apache license version 2", base=True),
    template("cc-by-nc", "cc by nc", base=True),
]
#: Short forms of public licence notices, with their key phrases: fixed values.
NOTICES = [
    template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge", least=LEAST_SHARE),
    template("mit", "Released under the MIT License", "mit license"),
    template("apache-2", "Licensed under the Apache License, Version 2.0", "apache license version 2 0"),
    template("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    template("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License", "attribution noncommercial"),
    template("cc-by", "Licensed under CC BY 4.0", "cc by 4 0"),
    template("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    template("cc0", "CC0 1.0 Universal Public Domain Dedication", "public domain dedication", least=LEAST_SHARE),
    template("gpl-3", "This work is licensed under the GNU General Public License, version 3", "gnu general public license version 3"),
    template("gpl-2", "This work is licensed under the GNU General Public License, version 2", "gnu general public license version 2"),
    template("lgpl", "This library is free software under the GNU Lesser General Public License", "gnu lesser general public license"),
    template("agpl", "under the terms of the GNU Affero General Public License", "gnu affero general public license"),
    template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution and use in source and binary forms"),
    template("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license", least=LEAST_SHARE),
    template("unlicense", "This is free and unencumbered software released into the public domain", "free and unencumbered software"),
    template("all-rights-reserved", "All rights reserved", "all rights reserved"),
    # titles and standard notices
    template("mit", "MIT License", "mit license"),
    template("mit", "The MIT License", "mit license"),
    template("apache-2", "Apache License Version 2.0, January 2004", "apache license version 2 0"),
    template("cc-by", "Licensed under CC BY 3.0", "cc by 3 0"),
    template("cc-by", "Creative Commons Attribution 4.0 International License", "attribution 4 0 international"),
    template("cc-by", "Creative Commons Attribution 3.0 Unported License", "attribution 3 0 unported"),
    template("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License", "attribution sharealike"),
    template("cc-by-sa", "Creative Commons Attribution-ShareAlike 3.0 Unported License", "attribution sharealike"),
    template("cc-by-sa", "CC BY-SA 3.0", "cc by sa"),
    template("cc-by-sa", "CC BY-SA 4.0", "cc by sa"),
    template("cc-by-nc", "CC BY-NC 4.0", "cc by nc"),
    template("cc0", "CC0 1.0 Universal", "cc0 1 0"),
    template("gpl-3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "gnu general public license version 3"),
    template("gpl-3", "under the terms of the GNU General Public License, version 3", "gnu general public license version 3"),
    template("gpl-3", "GNU General Public License v3.0", "gnu general public license v3"),
    template("gpl-3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "gnu general public license as published by the free software foundation either version 3"),
    template("gpl-3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License", "gnu general public license as published by the free software foundation version 3"),
    template("gpl-2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "gnu general public license version 2"),
    template("gpl-2", "under the terms of the GNU General Public License, version 2", "gnu general public license version 2"),
    template("gpl-2", "GNU General Public License v2.0", "gnu general public license v2"),
    template("gpl-2", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version", "gnu general public license as published by the free software foundation either version 2"),
    template("gpl-2", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 2 of the License", "gnu general public license as published by the free software foundation version 2"),
    template("lgpl", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "gnu lesser general public license"),
    template("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "gnu lesser general public license"),
    template("lgpl", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "gnu lesser general public license"),
    template("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version", "gnu lesser general public license"),
    template("lgpl", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991", "gnu library general public license"),
    template("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version", "gnu library general public license"),
    template("lgpl", "under the terms of the GNU Lesser General Public License", "gnu lesser general public license"),
    template("agpl", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "gnu affero general public license"),
    template("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "gnu affero general public license"),
    template("mpl-2", "Mozilla Public License Version 2.0", "mozilla public license version 2 0"),
    template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license v 2 0"),
]


#: Bodies of public licences, each with its key phrases in order: fixed values.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
    "3. This notice may not be removed or altered from any source distribution."
)
_APACHE_2 = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
    "See the License for the specific language governing permissions and limitations under the License."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain."
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, "
    "and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"
)
_MPL_2 = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
BODIES = [
    template("mit", _MIT, "permission is hereby granted free of charge to any person obtaining a copy", "to deal in the software without restriction", "shall be included in all copies or substantial portions of the software"),
    template("bsd", _BSD_2 + _BSD_END, "redistribution and use in source and binary forms", "redistributions of source code must retain", "redistributions in binary form must reproduce"),
    template("bsd-3", _BSD_2 + _BSD_3 + _BSD_END, "redistributions of source code must retain", "redistributions in binary form must reproduce", "to endorse or promote products derived from this software"),
    template("isc", _ISC, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "this permission notice appear in all copies"),
    template("zlib", _ZLIB, "the origin of this software must not be misrepresented", "altered source versions must be plainly marked", "may not be removed or altered from any source distribution"),
    template("apache-2", _APACHE_2, "except in compliance with the license", "unless required by applicable law or agreed to in writing", "governing permissions and limitations under the license"),
    template("unlicense", _UNLICENSE, "free and unencumbered software", "dedicate any and all copyright interest in the software to the public domain"),
    template("boost", _BOOST, "permission is hereby granted free of charge to any person or organization", "and to prepare derivative works of the software"),
    template("mpl-2", _MPL_2, "subject to the terms of the mozilla public license v 2 0", "if a copy of the mpl was not distributed with this file"),
]
TEMPLATES = [*BASE, *NOTICES, *BODIES]


def places_of(t: Template) -> list[tuple[int, tuple[bytes, ...]]]:
    """(position, words) of the key phrases in the template, each after the one before."""
    out, at = [], 0
    for p in t.phrases:
        at = next(i for i in range(at, len(t.words)) if t.words[i : i + len(p)] == p)
        out.append((at, p))
    return out


class PositionalIndex:
    """Postings of the key phrases' rarest words, as the corpus's document frequencies have it."""

    def __init__(self, templates: list[Template], documents: int, frequency: dict[bytes, int]):
        self.templates = templates
        words = {w for t in templates for w in t.words}
        self.idf = {w: math.log((documents + 1) / (frequency.get(w, 0) + 0.5)) for w in words}
        self.phrases: list[tuple[int, int, tuple[bytes, ...]]] = []  # (template, position in it, words)
        #: For each rank of rarity: word -> (phrase, position in the template).
        self.postings: list[dict[bytes, list[tuple[int, int]]]] = [{} for _ in range(ANCHORS)]
        self.needed: list[int] = []
        for k, t in enumerate(templates):
            for start, phrase in places_of(t):
                rarest = sorted(range(len(phrase)), key=lambda i: (-self.idf[phrase[i]], i))[:ANCHORS]
                for rank, i in enumerate(rarest):
                    self.postings[rank].setdefault(phrase[i], []).append((len(self.phrases), start + i))
                self.phrases.append((k, start, phrase))
                self.needed.append(len(rarest))
        self.orders = [sorted(p, key=lambda w: (-self.idf[w], w)) for p in self.postings]
        self.wanted = frozenset(w for p in self.postings for w in p)

    def alignments(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(phrase, start of its template): where the postings of all its rare words agree."""
        where: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.wanted:
                where.setdefault(w, []).append(i)
        agreed: dict[tuple[int, int], int] = {}
        for rank, postings in enumerate(self.postings):
            for w in self.orders[rank]:
                for at in where.get(w, ()):
                    for f, offset in postings[w]:
                        if agreed.get((f, at - offset), 0) == rank:
                            agreed[f, at - offset] = rank + 1
        return [key for key, n in agreed.items() if n == self.needed[key[0]]]

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, first word of its first key phrase, share of the template), every place."""
        if self.postings[0].keys().isdisjoint(words):
            return []
        starts: dict[int, dict[int, list[int]]] = {}
        for f, start in self.alignments(words):
            k, place, phrase = self.phrases[f]
            if start + place >= 0 and tuple(words[start + place : start + place + len(phrase)]) == phrase:
                starts.setdefault(k, {}).setdefault(place, []).append(start)
        out = []
        for k, by_place in sorted(starts.items()):
            t, places = self.templates[k], list(dict.fromkeys(p for p, _ in places_of(self.templates[k])))
            if len(by_place) < len(places):
                continue
            ordered = [sorted(by_place[p]) for p in places]
            for first in ordered[0]:
                near = [first, *(nearest(starts, first) for starts in ordered[1:])]
                if all(abs(s - first) <= SLACK for s in near):
                    share = aligned_share(words, t.words, set(near))
                    if share >= t.least:
                        out.append((k, first + places[0], share))
        return out


def nearest(ordered: list[int], to: int) -> int:
    """The closest of sorted numbers, the smaller of two as close."""
    at = bisect.bisect_left(ordered, to)
    return min(ordered[max(0, at - 1) : at + 1], key=lambda s: (abs(s - to), s))


def aligned_share(words: list[bytes], body: tuple[bytes, ...], starts: set[int]) -> float:
    """The share of a template's words that stand at their relative position from any start."""
    hit = [False] * len(body)
    for start in starts:
        here = words[max(0, start) : max(0, start + len(body))]
        for i, same in enumerate(map(bytes.__eq__, here, body[max(0, -start) :]), max(0, -start)):
            hit[i] |= same
    return sum(hit) / len(body)


def word_frequencies(docs: DataFrame, templates: list[Template], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Documents, and in how many each template word stands; over all documents."""
    vocabulary = frozenset(w for t in templates for w in t.words)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        rows = 0
        for batch in batches:
            rows += len(batch)
            for text in batch.column(0):
                found.update(vocabulary.intersection(alnum(text.as_py() or b"")))
        yield pa.RecordBatch.from_pydict({"word": pa.array([b"", *found], pa.binary()), "n": pa.array([rows, *found.values()], pa.int64())})

    counts = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    known = {bytes(r.word): r.n for r in counts.collect()}  # at most the templates' words
    return known.pop(b"", 0), known


MATCH = T.StructType([T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()), T.StructField("start", T.LongType()), T.StructField("share", T.DoubleType())])


def scan(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, matches) of every row; a match has label, base, start and share."""
    templates = templates or TEMPLATES
    index = docs.sparkSession.sparkContext.broadcast(PositionalIndex(templates, *word_frequencies(docs, templates, text_col)))
    match_type = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("share", pa.float64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            n_words, matches = [], []
            for text in batch.column(1):
                words = alnum(text.as_py() or b"")
                n_words.append(len(words))
                matches.append([{"label": own.templates[k].label, "base": own.templates[k].base, "start": at, "share": share} for k, at, share in own.matches(words)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(matches, match_type)], names=[id_col, "n_words", "matches"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("matches", T.ArrayType(MATCH))])
    return docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("_text")).mapInArrow(scanned, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns; the score is the best share of a template, 0 without any."""
    base = F.filter("matches", lambda m: m["base"])
    listed = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")
    starts = F.transform(base, lambda m: m["start"])
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )
