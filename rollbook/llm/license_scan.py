r"""License scan by conditional compression.

Lines with a cue word are candidates; those at most GAP lines apart form a block.  It is
judged with as many words before and after it as the longest template can take, so the
wrap of a notice does not matter.  A candidate (the block for texts of SHORT words and more,
the words around a cue for shorter names and notices) is compressed with zstandard alone
and with each template as raw dictionary, all as lower-case words.  The bytes that a
template saves, as a share of what it costs alone, rank the templates; those that save
LEAST_GAIN or more are winners (and names of less than NAME_BYTES, in which the compressor finds
nothing to save), and the exact wording confirms them: at most
MOST_DIFFERENT of a template's words may be missing or put in between, none of a short one,
but for licence spelled with c or s.  A license is named by its best confirmed text.

Defined cases: a null or empty text has no block; a cue in prose makes a block that no
template confirms; equal savings rank by template name; a block may hold several
licenses and a document several blocks, and all confirmed ones are reported; rows are
judged one by one, so repeated rows and null ids stay as they are; an empty table gives
an empty result.  Extra columns are never read.  Texts are read whole; a run of more than
LONG words is cut to LONG words around each cue before it is widened, so that a page of
one line costs no more than its cues.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from difflib import SequenceMatcher
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm import text as tx

GAP = 2  # lines
LONG = 400  # words
MOST_DIFFERENT = 0.05  # of a template's words, missing or put in between
SHORT = 20  # words: below, a template must stand word by word
LEAST_GAIN = 0.25  # of a template's own cost that it must take off a candidate
NAME_BYTES = 24  # below, a name is too short for the compressor to tell, and always tried
LEVEL = 9
MIN_DICTIONARY = 16  # bytes; zstandard ignores shorter ones

CUE = re.compile(
    rb"licen[cs]|copyright|redistribut|permission\W+(?:is|to)\b|warrant|public\W+domain|creative\W+commons"
    rb"|\bcc\W+by|\bcc0|[al]?gplv?|\bmpl\b|apache|\bbsd|anyone\W+is\W+free|neither\W+the\W+name",
    re.I,
)
#: A word that every short template has, or stands beside.
NAME_CUE = re.compile(r"licens|gpl|mpl|^cc|apache|bsd|commons|domain|copyright|redistribut")
_TOKEN = re.compile(rb"[a-z0-9]+(?:[.+-][a-z0-9]+)*", re.I)
_WORD = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")

# License names, notices and texts as their authors publish them, by SPDX
# identifier; a text is given by paragraphs.  BSD-3-Clause is BSD-2-Clause with one clause more.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    "Apache-2.0": (
        "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
    ),
    "BSD-2-Clause": (
        "BSD-2-Clause", "BSD 2-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
    ),
    "BSD-3-Clause": (
        "BSD-3-Clause", "BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    ),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    "CC-BY-NC-4.0": (
        "CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International",
    ),
    "CC-BY-ND-4.0": (
        "CC BY-ND 4.0", "CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International",
    ),
    "CC-BY-SA-4.0": (
        "CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International",
    ),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0"),
    "GPL-2.0": (
        "GNU General Public License, version 2", "GNU General Public License v2", "GPL-2.0", "GPLv2",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "GNU General Public License, version 3", "GNU General Public License v3", "GPL-3.0", "GPLv3",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    "ISC": (
        "ISC License", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    "LGPL-3.0": (
        "GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3",
        "LGPL-3.0", "LGPLv3",
    ),
    "MIT": (
        "MIT License", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": (
        "Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "SPDX-License-Identifier: Unlicense",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    "Zlib": (
        "zlib License", "SPDX-License-Identifier: Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:",
    ),
}

RESULT = (
    "n_blocks int, found array<struct<license:string,saved:double,missing:int,extra:int>>"
)
_FOUND = pa.list_(pa.struct([
    ("license", pa.string()), ("saved", pa.float64()), ("missing", pa.int32()), ("extra", pa.int32())
]))


def words(text: str) -> list[str]:
    """Words of a text; licence and license are one spelling."""
    return [w.replace("licenc", "licens") for w in _WORD.findall(text.lower())]


def folded(own: list[str]) -> bytes:
    return " ".join(own).encode()


def differences(block: list[str], template: list[str]) -> tuple[int, int]:
    """Template words that the block lacks, and block words between those it has.  Common
    runs at the ends are left out where they are only words that stand nearby."""
    parts = SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks()[:-1]
    best = (len(template), 0)
    for i in range(len(parts)):
        matched = 0
        for last in parts[i:]:
            matched += last.size
            here = (len(template) - matched, last.b + last.size - parts[i].b - matched)
            best = min(best, here, key=lambda d: (max(d), sum(d)))
    return best


def stretches(block: list[str], bag: Counter[str], reach: int, least: int) -> Iterator[list[str]]:
    """All runs of ``reach`` words that share at least ``least`` with the bag, repeats counted."""
    have: Counter[str] = Counter()
    common = 0
    for k, word in enumerate(block):
        if word in bag:
            have[word] += 1
            common += have[word] <= bag[word]
        if k >= reach and (old := block[k - reach]) in bag:
            common -= have[old] <= bag[old]
            have[old] -= 1
        if common >= least and (k >= reach - 1 or k == len(block) - 1):
            yield block[max(0, k + 1 - reach) : k + 1]


class Template:
    """One text of a license, with the compressor that has it as dictionary."""

    def __init__(self, license_id: str, text: str, plain: zstandard.ZstdCompressor) -> None:
        self.license = license_id
        self.words = words(text)
        self.size = len(folded(self.words))
        self.bag = Counter(self.words)
        self.most = int(MOST_DIFFERENT * len(self.words))
        raw = zstandard.ZstdCompressionDict(
            folded(self.words).rjust(MIN_DICTIONARY), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self.aided = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_dict_id=False, write_content_size=False)
        #: What the text costs alone, beyond what nothing costs.
        self.cost = max(1, len(plain.compress(folded(self.words))) - len(plain.compress(b"")))

    def gain(self, candidate: bytes, alone: int) -> float:
        """How much of its own cost the template takes off a candidate."""
        return (alone - len(self.aided.compress(candidate))) / self.cost

    def wording(self, candidate: list[str]) -> tuple[int, int] | None:
        """Words missing and words put in, at the place where they are fewest; None if they are too
        many."""
        have = Counter(candidate)
        least = len(self.words) - self.most
        if sum(min(n, have[word]) for word, n in self.bag.items()) < least:
            return None
        best = None
        for stretch in stretches(candidate, self.bag, len(self.words) + self.most, least):
            found = differences(stretch, self.words)
            if max(found) <= self.most and (best is None or sum(found) < sum(best)):
                best = found
                if sum(best) == 0:
                    break
        return best


class Scanner:
    """Compressors and words of all templates; one for each task."""

    def __init__(self, templates: Mapping[str, Sequence[str]], least_gain: float = LEAST_GAIN) -> None:
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        texts = [Template(name, text, self.plain) for name in sorted(templates) for text in templates[name]]
        self.long = [t for t in texts if len(t.words) >= SHORT]
        self.short = [t for t in texts if len(t.words) < SHORT]
        self.least_gain = least_gain
        #: Words that a confirmed stretch may have.
        self.reach = max((len(t.words) + t.most for t in texts), default=0)

    def winners(self, candidate: list[str], templates: list[Template]) -> list[tuple[float, Template]]:
        """Templates that shorten a candidate enough, by falling gain."""
        raw = folded(candidate)
        alone = len(self.plain.compress(raw))
        ranked = [(t.gain(raw, alone), t) for t in templates]
        enough = [(g, t) for g, t in ranked if g >= self.least_gain or t.size < NAME_BYTES]
        return sorted(enough, key=lambda g: -g[0])

    def confirmed(self, block: bytes) -> list[dict]:
        """Licenses of a block: the best text of each by gain that the wording confirms.  Long texts are
        tried on the whole block, short ones on the words around each cue, as each holds
        one."""
        own = words(block.decode("utf-8", "replace"))
        candidates = [(own, self.long), *[(near, self.short) for near in around_cues(own)]]
        best: dict[str, dict] = {}
        for candidate, templates in candidates:
            for gain, t in self.winners(candidate, templates):
                if t.license in best and best[t.license]["saved"] >= gain:
                    continue
                if (found := t.wording(candidate)) is not None:
                    missing, extra = found
                    best[t.license] = {"license": t.license, "saved": gain, "missing": missing, "extra": extra}
        return [best[name] for name in sorted(best)]


def around_cues(own: list[str]) -> Iterator[list[str]]:
    """The words around each word of a cue, stretches that overlap made one."""
    spans: list[list[int]] = []
    for k, word in enumerate(own):
        if NAME_CUE.search(word):
            low, high = max(0, k - SHORT), min(len(own), k + SHORT + 1)
            if spans and low <= spans[-1][1] and high - spans[-1][0] <= 4 * SHORT:
                spans[-1][1] = high
            else:
                spans.append([low, high])
    for low, high in spans:
        yield own[low:high]


def widened(text: bytes, begin: int, end: int, reach: int) -> bytes:
    """This part of the text with ``reach`` words more on either side."""
    size = 16 * reach
    while True:
        low = max(0, begin - size)
        before = [m.start() for m in _TOKEN.finditer(text, low, begin)]
        if low == 0 or len(before) > reach:  # the first one may be cut
            break
        size *= 4
    after = [m.end() for m in islice(_TOKEN.finditer(text, end), reach)]
    return text[min([begin, *before[len(before) - min(reach, len(before)) :]]) : max([end, *after])]


def blocks(text: bytes, reach: int) -> list[bytes]:
    """Runs of lines with cues, cut around them where a run is long, and widened."""
    found = [m.span() for m in CUE.finditer(text)]
    cues = [at for at, _ in found]
    spans: list[list[int]] = []
    for at, last in found:
        begin = text.rfind(b"\n", 0, at) + 1
        end = text.find(b"\n", last - 1)
        end = len(text) if end < 0 else end
        if spans and (begin <= spans[-1][1] or text.count(b"\n", spans[-1][1], begin) <= GAP):
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([begin, end])
    out = []
    for begin, end in spans:
        places = [m.span() for m in re.finditer(rb"[^\s]+", text[begin:end])]
        if len(places) <= LONG:
            out.append((begin, end))
            continue
        # Word numbers around each cue, overlapping ones made one.
        inside = [at - begin for at in cues if begin <= at < end]
        cuts: list[list[int]] = []
        k = 0
        for at in inside:
            while k + 1 < len(places) and places[k + 1][0] <= at:
                k += 1
            low, high = max(0, k - LONG // 2), min(len(places), k + LONG // 2)
            if cuts and low <= cuts[-1][1]:
                cuts[-1][1] = high
            else:
                cuts.append([low, high])
        out += [(begin + places[a][0], begin + places[b - 1][1]) for a, b in cuts]
    return [widened(text, begin, end, reach) for begin, end in out]


def scan(docs: DataFrame, *keep: str, templates: Mapping[str, Sequence[str]] = TEMPLATES) -> DataFrame:
    """The columns of ``keep``, ``n_blocks`` and ``found``: confirmed licenses, by name."""
    packed = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kinds = dict(packed.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            for rows, texts in tx.pieces(batch):
                data = texts.data.tobytes()
                n_blocks, found = [], []
                for a, b in zip(texts.offsets[:-1], texts.offsets[1:]):
                    own = blocks(data[a:b], scanner.reach)
                    best: dict[str, dict] = {}
                    for block in own:
                        for hit in scanner.confirmed(block):
                            if hit["license"] not in best or hit["saved"] > best[hit["license"]]["saved"]:
                                best[hit["license"]] = hit
                    n_blocks.append(len(own))
                    found.append([best[k] for k in sorted(best)])
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in keep], pa.array(n_blocks, pa.int32()), pa.array(found, _FOUND)],
                    names=[*keep, "n_blocks", "found"],
                )

    return packed.mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], RESULT]))
