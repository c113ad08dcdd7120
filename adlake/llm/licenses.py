"""Licence scan: TF-IDF cosine of lines, header blocks and files to licence templates, and inheritance along paths."""

from __future__ import annotations

import importlib.resources
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.text import CODES, LOWER, NOT_ALNUM, Fingerprints, member, per_row, slices, words
from adlake.session import materialize

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_ASF = """Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work
for additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License."""
_GPL = """This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License
as published by the Free Software Foundation{comma} either version {version} of the License, or (at your option) any later version.
This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details.
You should have received a copy of the GNU {kind}General Public License along with this {what}. If not, see <https://www.gnu.org/licenses/>."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

#: Families with versions: licence, name in a sentence, kind in a header.
_GNU = [(f"{short}-{v}", f"GNU {kind}General Public License", kind, v) for short, kind, versions in (
    ("GPL", "", ("1.0", "2.0", "3.0")), ("LGPL", "Lesser ", ("2.1", "3.0")), ("AGPL", "Affero ", ("3.0",))) for v in versions]
#: Licences with one name each: those by which sentences call them.
_CALLED = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license"], "MIT": ["MIT License"], "ISC": ["ISC License"], "Zlib": ["zlib License"],
    "BSD-3-Clause": ["3-clause BSD License", "BSD 3-Clause License"], "BSD-2-Clause": ["2-clause BSD License", "BSD 2-Clause License"], "BSD": ["BSD License", "BSD-style license"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"], "MPL-1.1": ["Mozilla Public License Version 1.1"], "BSL-1.0": ["Boost Software License, Version 1.0"],
    "CC0-1.0": ["CC0 1.0 Universal"], "Unlicense": ["Unlicense"], "Artistic-1.0-Perl": ["Artistic License"],
    "GPL": ["GNU General Public License"], "LGPL": ["GNU Lesser General Public License", "GNU Library General Public License"], "AGPL": ["GNU Affero General Public License"],
    **{name: [f"{full}, version {v}", f"{full} v{v[0] if v[2] == '0' else v}", f"{name.split('-')[0]}v{v[0] if v[2] == '0' else v}"] for name, full, _, v in _GNU},
    **{f"CC-{k}-4.0": [f"CC {k} 4.0", f"Creative Commons {long} 4.0 International License"] for k, long in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))},
}
_SENTENCES = ["{}", "Licensed under the {}.", "Released under the {}.", "This file is released under the {}.", "This work is licensed under the {}.", "This project is licensed under the {} - see the LICENSE file for details."]
#: Stated without a version, or by any work: any other statement of a file says more.
GENERIC = {"proprietary", "GPL", "LGPL", "AGPL", "BSD"}

#: Notices and headers by which works name their licence.
TEMPLATES = list(dict.fromkeys([
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    ("BSD-2-Clause", "Released under the 2-clause BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("proprietary", "Copyright. All rights reserved."),
    ("proprietary", "All rights reserved."),
    ("Apache-2.0", _APACHE), ("Apache-2.0", _ASF), ("Apache-2.0", _ASF + _APACHE[_APACHE.index("\n"):]), ("MPL-2.0", _MPL),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file or at https://opensource.org/licenses/MIT."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    *[(name, _GPL.format(what=what, colon=colon, comma=comma, kind=kind, version=v[0] if v[2] == "0" else v))
      for name, _, kind, v in _GNU for what, colon, comma in (("program", ":", ","), ("library", ";", ";"))],
    *[(name, sentence.format(called)) for name, all_called in _CALLED.items() for called in all_called for sentence in _SENTENCES],
    *[(name, f"SPDX-License-Identifier: {name}") for name in _CALLED if name not in GENERIC],
    *[(name, f"SPDX-License-Identifier: {name}-{which}") for name, *_ in _GNU for which in ("only", "or-later")],
]))
#: A line, block or file states the licence of its best template from this cosine.
SIMILAR = 0.8
#: A file of this cosine as a whole to a template of the licence it states speaks for its directory.
FILE_SIMILAR = 0.6
#: A run of lines belongs to a template if this share of each line's squared weights lies on words of the template.
RUN_SHARE = 0.5


@cache
def licence_texts() -> list[tuple[str, str]]:
    """Whole licences, by the names of their files. Read on the driver alone."""
    files = importlib.resources.files("adlake.llm").joinpath("licence_texts").iterdir()
    return sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in files if f.name.endswith(".txt"))


_TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_OWN = "own string, score double, speaks boolean"


def terms_of(text: str) -> list[str]:
    return _TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


class Terms:
    """Words of slices of texts, and which terms of the templates they are."""

    def __init__(self, vocabulary: list[str]):
        self.rolling = Fingerprints()
        self.vocabulary = vocabulary
        data = np.frombuffer("".join(self.vocabulary).encode(), np.uint8)
        sizes = np.array([len(t.encode()) for t in self.vocabulary], np.int64)
        ends = np.cumsum(sizes)
        hashes = self.rolling.ranges(self.rolling.prefix(CODES[data]), ends - sizes, ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def scan(self, column):
        for first, last, data, bounds in slices(column):
            data = LOWER[data]
            starts, ends, rows = words(data, bounds, NOT_ALNUM)
            hashes = self.rolling.ranges(self.rolling.prefix(CODES[data]), starts, ends)
            lines = np.searchsorted(np.flatnonzero(data == 0x0A), starts) + rows  # no two documents share a line
            yield first, last, rows, lines, hashes

    def hashes_of(self, terms: np.ndarray) -> np.ndarray:
        return self.hashes[np.argsort(self.order)[terms]]

    def term(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the vocabulary of hashes that are in it."""
        return self.order[np.searchsorted(self.hashes, hashes)]


def document_frequencies(files: DataFrame, among: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of texts, and in how many each of the sorted hashes among occurs. Tasks send sums; the driver gets a number per hash."""
    sc = files.sparkSession.sparkContext
    asked, size = sc.broadcast(among), len(among)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, total = Terms([]), np.zeros(size + 1, np.int64)
        for batch in batches:
            for first, last, rows, _, hashes in terms.scan(batch["text"]):
                at = np.flatnonzero(member(hashes, asked.value))
                pairs = np.unique(rows[at] * (size + 1) + np.searchsorted(asked.value, hashes[at]))
                total += np.bincount(pairs % (size + 1), minlength=size + 1)
                total[-1] += last - first
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "n"])

    found, counts = files.select("text").mapInArrow(count, "place long, n long"), np.zeros(size + 1, np.int64)
    sums = found.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts[sums["place"].to_numpy()] = sums["n"].to_numpy()
    return int(counts[-1]), counts[:-1]


class Templates:
    """Templates as sparse vectors: terms, and what share of the template each is, whatever the texts.

    A term counts in the share by how few of the licences use it.
    """

    def __init__(self, templates: list[tuple[str, str]], texts: list[tuple[str, str]]):
        self.names = [name for name, _ in [*templates, *texts]]
        self.whole = np.arange(len(self.names)) >= len(templates)
        counts = [Counter(terms_of(text)) for _, text in [*templates, *texts]]
        self.vocabulary = sorted(set().union(*counts))
        place = {t: k for k, t in enumerate(self.vocabulary)}
        users: dict[str, set[str]] = {t: set() for t in self.vocabulary}
        for name, found in zip(self.names, counts):
            for t in found:
                users[t].add(name)
        rare = np.array([math.log((1 + len(set(self.names))) / (1 + len(users[t]))) + 1 for t in self.vocabulary])
        self.terms = [np.array([place[t] for t in found], np.int64) for found in counts]
        self.tf = [1 + np.log(np.array(list(found.values()), float)) for found in counts]
        self.shares = [(tf * rare[at]) ** 2 for tf, at in zip(self.tf, self.terms)]
        self.shares = [x / x.sum() for x in self.shares]

    def weigh(self, idf: np.ndarray, unknown: float, least: float) -> None:
        """anchors: terms of which each text that holds ``least`` of a template has one; the rarest, so that few others do."""
        self.idf, self.unknown, anchors = idf, unknown, set()
        self.others, self.others_idf = np.zeros(0, np.uint64), np.zeros(0)
        for at, share in zip(self.terms, self.shares):
            order = np.argsort(-idf[at], kind="stable")
            anchors.update(at[order[: int(np.searchsorted(np.cumsum(share[order]), 1 - least + 1e-9)) + 1]].tolist())
        self.anchors = np.array(sorted(anchors), np.int64)

    def dense(self, k: int, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.vocabulary))
        out[self.terms[k]] = values
        return out

    def covering(self, rows: np.ndarray, term: np.ndarray, size: int, least: float) -> dict[int, np.ndarray]:
        """By template: which rows hold ``least`` of it; rows, term: distinct pairs."""
        found = {}
        for k, share in enumerate(self.shares):
            held = np.bincount(rows, self.dense(k, share)[term], minlength=size) >= least - 1e-9
            if held.any():
                found[k] = held
        return found


class Vectors:
    """TF-IDF vectors of units, which are runs of words with the same number."""

    def __init__(self, terms: Terms, templates: Templates, unit: np.ndarray, hashes: np.ndarray, size: int):
        order = np.lexsort((hashes, unit))
        unit, hashes = unit[order], hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = (unit[1:] != unit[:-1]) | (hashes[1:] != hashes[:-1])
        at = np.flatnonzero(new)
        self.unit, found, tf = unit[at], hashes[at], 1 + np.log(np.diff(at, append=len(order)))
        known = member(found, terms.hashes)
        self.term = terms.term(found[known])
        weight = np.full(len(at), templates.unknown)
        weight[known] = templates.idf[self.term]
        other = member(found, templates.others)
        weight[other] = templates.others_idf[np.searchsorted(templates.others, found[other])]
        self.strange = self.unit[~known], found[~known]
        weight *= tf
        self.templates, self.size = templates, size
        self.squares = np.bincount(self.unit, weight**2, minlength=size)
        self.unit, self.weight = self.unit[known], weight[known]

    def cosines(self, k: int) -> np.ndarray:
        """Over the words of each unit, times the root of the share of template k that the unit holds."""
        t = self.templates
        vector = t.dense(k, t.tf[k] * t.idf[t.terms[k]])[self.term]
        on = np.flatnonzero(vector)
        unit, vector, share = self.unit[on], vector[on], t.dense(k, t.shares[k])[self.term[on]]
        dot, among, held = (np.bincount(unit, x, minlength=self.size) for x in (self.weight[on] * vector, vector**2, share))
        return dot / np.maximum(np.sqrt(self.squares * among), 1e-12) * np.sqrt(np.minimum(held, 1))

    def belonging(self, k: int) -> np.ndarray:
        """Which units lie on words of template k, by RUN_SHARE of their squares."""
        on = self.templates.dense(k, self.templates.shares[k])[self.term] > 0
        return np.bincount(self.unit[on], self.weight[on] ** 2, minlength=self.size) >= RUN_SHARE * np.maximum(self.squares, 1e-12)


    def strangers(self, units: np.ndarray) -> np.ndarray:
        """Words of the marked units that no template holds."""
        unit, hashes = self.strange
        return np.unique(hashes[units[unit]])


def numbered(changes: np.ndarray) -> np.ndarray:
    return np.cumsum(changes) - 1 if len(changes) else np.zeros(0, np.int64)


def statements(terms: Terms, templates: Templates, rows: np.ndarray, lines: np.ndarray, hashes: np.ndarray, size: int, similar: float, file_similar: float) -> tuple[list[tuple[int, int, float]], dict[tuple[int, str], float], list[np.ndarray]]:
    """(row, template, cosine) of every unit that states a licence, by row and licence the cosine of the whole file, and what words outside the templates matter."""
    has = np.zeros(size, bool)
    has[rows[member(hashes, np.sort(terms.hashes_of(templates.anchors)))]] = True
    pick = np.flatnonzero(has[rows])
    known = pick[member(hashes[pick], terms.hashes)]
    width = len(templates.vocabulary)
    pairs = np.unique(rows[known] * width + terms.term(hashes[known]))
    covered = templates.covering(pairs // width, pairs % width, size, similar**2)
    if not covered:
        return [], {}, []
    pick = np.flatnonzero(np.any(list(covered.values()), axis=0)[rows])
    rows, lines, hashes = rows[pick], lines[pick], hashes[pick]
    fresh = np.ones(len(lines), bool)
    fresh[1:] = lines[1:] != lines[:-1]
    line = numbered(fresh)
    row_of_line, number = rows[fresh], lines[fresh]
    apart = np.ones(len(number), bool)  # a line without words ends a block
    apart[1:] = (number[1:] != number[:-1] + 1) | (row_of_line[1:] != row_of_line[:-1])
    block = numbered(apart)
    found, whole, strange = [], {}, []
    by_line = Vectors(terms, templates, line, hashes, len(number))
    by_block = Vectors(terms, templates, block[line], hashes, int(block[-1]) + 1)
    by_file = Vectors(terms, templates, rows, hashes, size)
    row_of_block = row_of_line[apart]
    for k, held in covered.items():
        for vectors, row_of in ((by_line, row_of_line), (by_block, row_of_block), (by_file, np.arange(size))):
            cosine = vectors.cosines(k)
            found += [(int(row_of[u]), k, float(cosine[u])) for u in np.flatnonzero(cosine >= similar)]
            strange.append(vectors.strangers(cosine >= (min(similar, file_similar) if vectors is by_file else similar)))
            if vectors is by_file:
                for u in np.flatnonzero(held).tolist():
                    key = (u, templates.names[k])
                    whole[key] = max(whole.get(key, 0.0), float(cosine[u]))
        belong = by_line.belonging(k) & held[row_of_line]  # runs of lines, also over those without words
        strange.append(by_line.strangers(belong))
        of = np.flatnonzero(belong)
        if len(of) < 2:
            continue
        begins = np.ones(len(of), bool)
        begins[1:] = (of[1:] != of[:-1] + 1) | (row_of_line[of[1:]] != row_of_line[of[:-1]])
        run = np.full(len(number), -1)
        run[of] = numbered(begins)
        long = per_row(run[of], int(run[of[-1]]) + 1) > 1
        run[of[~long[run[of]]]] = -1
        at = np.flatnonzero(run[line] >= 0)
        cosine = Vectors(terms, templates, run[line[at]], hashes[at], len(long)).cosines(k)
        row_of = row_of_line[of[begins]]
        found += [(int(row_of[u]), k, float(cosine[u])) for u in np.flatnonzero(cosine >= similar)]
    return found, whole, strange


def own_licences(files: DataFrame, templates: list[tuple[str, str]], texts: list[tuple[str, str]], similar: float, file_similar: float) -> DataFrame:
    """files (file, path, text) with own (licence of the best statement), score and speaks (is a licence file), without the text."""
    against = Templates(templates, texts)
    known = Terms(against.vocabulary)
    n, frequencies = document_frequencies(files, known.hashes)
    idf = np.empty(len(frequencies))
    idf[known.order] = np.log((1 + n) / (1 + frequencies)) + 1
    against.weigh(idf, 1.0, similar**2)  # no word weighs less than 1, so no statement is missed

    def strange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(against.vocabulary)
        for batch in batches:
            for first, last, rows, lines, hashes in terms.scan(batch["text"]):
                asked = statements(terms, against, rows, lines, hashes, last - first, similar, file_similar)[2]
                if asked:
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(asked)).view(np.int64))], names=["hash"])

    others = np.sort(files.select("text").mapInArrow(strange, "hash long").distinct().toArrow()["hash"].to_numpy().view(np.uint64))
    n, frequencies = document_frequencies(files, others) if len(others) else (n, np.zeros(0, np.int64))
    against.unknown = math.log(1 + n) + 1  # of units that state nothing
    weights = files.sparkSession.sparkContext.broadcast((others, np.log((1 + n) / (1 + frequencies)) + 1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, names = Terms(against.vocabulary), against.names
        against.others, against.others_idf = weights.value
        for batch in batches:
            for first, last, rows, lines, hashes in terms.scan(batch["text"]):
                found, whole, _ = statements(terms, against, rows, lines, hashes, last - first, similar, file_similar)
                best: dict[int, tuple] = {}
                for row, k, cosine in found:  # whole licences first, then the larger cosine, then the first name
                    says = (not against.whole[k], names[k] in GENERIC, -round(cosine, 9), names[k])
                    best[row] = min(best.get(row, says), says)
                own = [best[k][3] if k in best else None for k in range(last - first)]
                score = [-best[k][2] if k in best else 0.0 for k in range(last - first)]
                speaks = [name is not None and whole.get((k, name), 0.0) >= file_similar for k, name in enumerate(own)]
                yield pa.RecordBatch.from_arrays([
                    batch["file"][first:last], batch["path"][first:last], pa.array(own, pa.string()), pa.array(score, pa.float64()), pa.array(speaks, pa.bool_()),
                ], names=["file", "path", "own", "score", "speaks"])

    kind = files.schema["file"].dataType.simpleString()
    return files.select("file", "path", "text").mapInArrow(scan, f"file {kind}, path string, {_OWN}")


def licences(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, similar: float = SIMILAR, file_similar: float = FILE_SIMILAR, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """file, path, licence, origin (header, inherited, none), score, directory (whose licence file speaks).

    files: file, path, text. Compared as sparse TF-IDF vectors, with document frequencies of all words over all texts
    (words outside the templates are counted if a unit with them can be a statement, the driver gets a number for each) and 1 + log of the count of a word, are: each line; each block, which is lines up to one without words; the longest
    runs of lines that lie on words of a template, over lines without words too, so wrapped headers anywhere; and
    the whole file. Templates are notices and headers (``templates``) and whole licences (``texts``; by default those of
    ``licence_texts``). The cosine is taken over the words of the unit, times the root of the share of the template
    that it holds; that share does not depend on the texts, so frequencies of words that it lacks change nothing.

    A unit states the template of the largest cosine, from ``similar`` on. Of its statements a file has that of a whole
    licence first, then those that are not GENERIC, then the best score, then the first by name. A file whose words as a
    whole have a cosine of ``file_similar`` or more to a template of its licence is a licence file and speaks for its
    directory: of several the one of the best score, then the first by licence. Files without a statement inherit
    from the nearest directory above them that has a licence file.

    Null and empty texts state nothing but inherit; a null path is a file in the root. Repeated rows each get a
    result. Other columns don't matter. No files: no rows. Inheritance is settled per directory, so files meet
    one row each.
    """
    files = files.select("file", F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    directory = F.regexp_replace("path", r"/?[^/]*$", "")
    found = own_licences(files, templates, licence_texts() if texts is None else texts, similar, file_similar)
    found = materialize(found, "found").withColumn("at", directory)  # read three times below
    speaks = found.filter("speaks")
    spoken = speaks.groupBy("at").agg(F.min(F.struct((-F.col("score")).alias("minus"), "own")).alias("best")).select(F.col("at").alias("above"), F.col("best.own").alias("told"))
    parts = F.split("at", "/")
    directories = found.filter("own is null").select("at").distinct().withColumn("parts", F.when(F.col("at") == "", F.array().cast("array<string>")).otherwise(parts))
    climbed = directories.select("at", F.explode(F.sequence(F.lit(0), F.size("parts"))).alias("depth"), "parts").select("at", "depth", F.expr("array_join(slice(parts, 1, depth), '/')").alias("above"))
    nearest = climbed.join(spoken, "above").groupBy("at").agg(F.max(F.struct("depth", "told", "above")).alias("near")).select("at", F.col("near.told").alias("told"), F.col("near.above").alias("above"))
    given = found.join(nearest, "at", "left")
    own = F.col("own").isNotNull()
    return given.select(
        "file", "path", F.coalesce("own", "told").alias("licence"),
        F.when(own, "header").when(F.col("told").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.round("score", 6).alias("score"), F.when(~own, F.col("above")).alias("directory"),
    )
