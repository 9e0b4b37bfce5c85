"""Licence scans by a positional index of rare words.

Templates of licence notices are indexed by word: a posting says in which template and at which position a
word stands. How rare the words are is counted over all documents. In a file the licence words it has are ranked, the rarest
first, and looked up in this order until each template that the file could hold has its rarest places looked up. Each place where
such a word stands puts the template at one offset; the offsets of its rarest places are intersected, so only places at which
these words stand as far apart as in the template are left. There the mandatory key phrases must stand word by word. The share
of the template that agrees is the score.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """A notice in words of a-z and 0-9; each key phrase is (first word, words) of the text.

    ``need`` of the key phrases must stand at their places, by default all.
    """

    label: str
    text: str
    keys: tuple[tuple[int, int], ...]
    base: bool = False
    need: int = 0

    @property
    def needed(self) -> int:
        return self.need or len(self.keys)

    @property
    def words(self) -> tuple[bytes, ...]:
        return tuple(self.text.encode().split())


def notice(label: str, text: str, *phrases: str, need: int = 0) -> Template:
    """A whole notice and its key phrases, which are parts of it."""
    words = text.split()
    keys = []
    for part in (p.split() for p in phrases):
        keys.append((next(i for i in range(len(words)) if words[i : i + len(part)] == part), len(part)))
    return Template(label, text, tuple(keys), need=need)


def phrase(label: str, text: str, base: bool = False) -> Template:
    """A template that is one key phrase."""
    return Template(label, text, ((0, len(text.split())),), base)


# Phrases and their labels.
BASE_TEMPLATES = (
    phrase("mit", "under the mit license", True),
    phrase("apache-2", "apache license version 2", True),
    phrase("cc-by-nc", "cc by nc", True),
)
# Public licence notices as they are put into files, and usual phrases.
MORE_TEMPLATES = (
    notice(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the rights"
        " to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom"
        " the software is furnished to do so subject to the following conditions the above copyright notice and this permission"
        " notice shall be included in all copies or substantial portions of the software",
        "permission is hereby granted free of charge",
        "to deal in the software without restriction",
        "copies or substantial portions of the software",
        need=2,
    ),
    # The opening alone is quoted often.
    notice(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge",
        "without restriction",
    ),
    notice(
        "apache-2",
        "licensed under the apache license you may not use this file except in compliance with the license",
        "you may not use this",
        "compliance with the license",
    ),
    notice(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"
        " you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or"
        " agreed to in writing software distributed under the license is distributed on an as is basis without warranties or"
        " conditions of any kind either express or implied see the license for the specific language governing permissions and"
        " limitations under the license",
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
        "specific language governing permissions and limitations under the license",
        need=2,
    ),
    notice(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    notice(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
        " conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the"
        " following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and"
        " the following disclaimer in the documentation and or other materials provided with the distribution",
        "redistribution and use in source and binary forms",
        "redistributions of source code must retain the above copyright notice",
        "redistributions in binary form must reproduce the above copyright notice",
        need=2,
    ),
    notice(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted",
        "permission to use copy modify and or distribute this",
        "with or without fee",
    ),
    notice(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
        " provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and or distribute this software",
        "for any purpose with or without fee",
        "this permission notice appear in all copies",
        need=2,
    ),
    notice(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
        "into the public domain",
    ),
    notice(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile"
        " sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or"
        " non commercial and by any means",
        "free and unencumbered software released into the public domain",
        "anyone is free to copy modify publish use compile sell or distribute this software",
        "for any purpose commercial or non commercial and by any means",
        need=2,
    ),
    notice(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"
        " as published by the free software foundation either version 3 of the license or at your option any later version",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
        "as published by the free software foundation",
        "at your option any later version",
        need=2,
    ),
    notice(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public"
        " license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        "under the terms of the gnu lesser general public license",
        "as published by the free software foundation",
    ),
    notice(
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public"
        " license as published by the free software foundation either version 3 of the license or at your option any later version",
        "under the terms of the gnu affero general public license",
        "as published by the free software foundation",
    ),
    notice(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed"
        " with this file you can obtain one at https mozilla org mpl 2 0",
        "this source code form is subject to the terms of the mozilla public license",
        "if a copy of the mpl was not distributed with this file",
        "you can obtain one at",
        need=2,
    ),
    notice(
        "epl",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is"
        " available at https www eclipse org legal epl 2 0",
        "this program and the accompanying materials are made available",
        "under the terms of the eclipse public license",
    ),
    notice(
        "cc-by-sa",
        "this work is licensed under the creative commons attribution sharealike 4 0 international license to view a copy of this"
        " license visit http creativecommons org licenses by sa 4 0",
        "this work is licensed under",
        "creative commons attribution sharealike",
    ),
    phrase("mit", "released under mit license"),
    phrase("bsd", "under the bsd license"),
    phrase("gpl", "gnu general public license"),
    phrase("lgpl", "gnu lesser general public license"),
    phrase("agpl", "gnu affero general public license"),
    phrase("mpl-2", "mozilla public license version 2"),
    phrase("epl", "eclipse public license"),
    phrase("cc-by-nc", "creative commons attribution noncommercial"),
    phrase("cc-by-sa", "cc by sa"),
    phrase("cc0", "cc0 1 0 universal"),
)
TEMPLATES = BASE_TEMPLATES + MORE_TEMPLATES
# Places of a key phrase, its rarest ones, whose offsets are intersected.
LOOKED_UP = 3
# Share of a template's words that must stand at their places, besides the key phrases.
MIN_SHARE = 0.5

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
# Capitals become small, all that is in no word becomes a blank. UTF-8 bytes beyond ASCII stay.
_FOLD = bytes(
    ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _texts(column: pa.Array):
    return (x.as_py() or b"" for x in column.cast(pa.large_binary()))


def document_counts(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> dict[bytes, int]:
    """In how many rows each word of the templates stands; the driver gets one row for each such word."""
    vocabulary = frozenset(w for t in templates for w in t.words)

    def of_partition(batches):
        counts: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for text in _texts(batch.column(0)):
                for w in vocabulary.intersection(words_of(text)):
                    counts[w] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    found = docs.select("text").mapInArrow(of_partition, "word binary, n bigint")
    return {bytes(r["word"]): r["n"] for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class LicenseIndex:
    """Postings of the template words, with their rarity, and the scan of one file."""

    def __init__(self, templates: Sequence[Template], counts: dict[bytes, int], rows: int):
        self.templates = tuple(templates)
        vocabulary = {w for t in templates for w in t.words}
        self.idf = {w: math.log((rows + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}
        # word -> (template, key phrase, position) of its places in key phrases.
        self.postings: dict[bytes, list[tuple[int, int, int]]] = defaultdict(list)
        self.sizes: dict[tuple[int, int], int] = {}  # places to look up for a key phrase
        self.words: dict[tuple[int, int], frozenset[bytes]] = {}
        for k, t in enumerate(self.templates):
            for j, (first, size) in enumerate(t.keys):
                self.sizes[k, j] = min(LOOKED_UP, size)
                self.words[k, j] = frozenset(t.words[first : first + size])
                for i in range(first, first + size):
                    self.postings[t.words[i]].append((k, j, i))

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, offset, share) of every place where a template is verified, by template and offset."""
        present = self.postings.keys() & set(words)
        # Without all words of a key phrase it can't stand in the file.
        open_ = {key: self.sizes[key] for key, needs in self.words.items() if needs <= present}
        held: dict[int, int] = defaultdict(int)
        for k, _ in open_:
            held[k] += 1
        open_ = {key: n for key, n in open_.items() if held[key[0]] >= self.templates[key[0]].needed}
        if not open_:
            return []
        at = self._positions(words, {w for key in open_ for w in self.words[key]})
        offsets = self._offsets(at, open_)
        found = []
        for k in sorted({k for k, _ in offsets}):
            t = self.templates[k]
            for offset in sorted(set().union(*(o for (x, _), o in offsets.items() if x == k))):
                if self._verified(t, words, offset):
                    share = self._votes(t, words, offset)
                    if share >= MIN_SHARE:
                        found.append((k, offset + t.keys[0][0], share))
        return found

    @staticmethod
    def _positions(words: list[bytes], wanted: set[bytes]) -> dict[bytes, list[int]]:
        at: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            if w in wanted:
                at[w].append(p)
        return at

    def _offsets(self, at: dict[bytes, list[int]], open_: dict) -> dict[tuple[int, int], set[int]]:
        """For each key phrase the offsets on which its rarest places agree, looked up word by word, the rarest of the file first."""
        offsets: dict[tuple[int, int], set[int]] = {}
        left = dict(open_)
        for w in sorted(at, key=lambda w: (-self.idf[w], w)):
            for k, j, i in self.postings[w]:
                if not left.get((k, j)):
                    continue
                here = {p - i for p in at[w]}
                offsets[k, j] = offsets[k, j] & here if (k, j) in offsets else here
                left[k, j] -= 1
            if not any(left.values()):
                break
        return offsets

    @staticmethod
    def _verified(t: Template, words: list[bytes], offset: int) -> bool:
        stand = 0
        for s, n in t.keys:
            if offset + s >= 0 and tuple(words[offset + s : offset + s + n]) == t.words[s : s + n]:
                stand += 1
        return stand >= t.needed

    def _votes(self, t: Template, words: list[bytes], offset: int) -> float:
        """Share of the template's rarity whose words stand at their relative positions."""
        total = agreed = 0.0
        for i, w in enumerate(t.words):
            weight = self.idf[w] + 1e-9
            total += weight
            if 0 <= offset + i < len(words) and words[offset + i] == w:
                agreed += weight
        return agreed / total


_RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    " base_labels string, labels string, score double"
)


def scan_licenses(docs: DataFrame, more: Sequence[Template] = MORE_TEMPLATES) -> DataFrame:
    """Licence phrases and labels of every whole text.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are their smallest and largest
    start, ``score`` is the best share of a template found (1 for whole phrases, 0 without a label). A null text is
    empty; a very long one is scanned whole, and the positions of its licence words are held. Repeated rows get equal results; an empty table gives an empty one.
    """
    templates = (*BASE_TEMPLATES, *more)
    docs = docs.select("doc_id", "text")
    counts = document_counts(docs, templates)
    rows = docs.count()
    names = [f.split()[0] for f in _RESULT.split(", ")]

    def of_batch(texts: pa.Array) -> pa.Array:
        index = LicenseIndex(templates, counts, rows)
        out = []
        for text in _texts(texts):
            words = words_of(text)
            found = index.scan(words)
            base = [(k, p) for k, p, _ in found if templates[k].base]
            starts = [p for _, p in base]
            out.append(
                {
                    "n_words": len(words),
                    "n_base": len(base),
                    "first_word": min(starts, default=None),
                    "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted({templates[k].label for k, _ in base})),
                    "labels": ",".join(sorted({templates[k].label for k, _, _ in found})),
                    "score": round(max((s for _, _, s in found), default=0.0), 6),
                }
            )
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return pa.StructArray.from_arrays(
            [pa.array([r[n] for r in out], t) for n, t in zip(names, types, strict=True)], names
        )

    told = docs.withColumn("_l", F.arrow_udf(of_batch, _RESULT)(F.col("text")))
    return told.select("doc_id", *[F.col(f"_l.{n}").alias(n) for n in names])


def oracle_sql(templates: Sequence[Template] = TEMPLATES) -> str:
    """The same in SQL: every offset of every template that a text has enough key phrases' words of, without an index."""

    def listed(values) -> str:
        return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"

    rows = []
    for k, t in enumerate(templates):
        words = t.text.split()
        starts, sizes = zip(*t.keys, strict=True)
        rows.append(
            f"({k}, '{t.label}', {t.base}, {listed(words)}, {t.needed}, {listed(starts)}, {listed(sizes)})"
        )
    most = max(len(t.keys) for t in templates)

    def key(j: int) -> str:
        here = f"w[off + s[{j}] + 1 : off + s[{j}] + n[{j}]] = words[s[{j}] + 1 : s[{j}] + n[{j}]]"
        return f"CASE WHEN len(s) >= {j} AND off + s[{j}] >= 0 AND {here} THEN 1 ELSE 0 END"

    def has(j: int) -> str:
        return f"CASE WHEN len(s) >= {j} AND list_has_all(w, words[s[{j}] + 1 : s[{j}] + n[{j}]]) THEN 1 ELSE 0 END"

    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t(k, label, base, words, need, s, n) AS (VALUES {", ".join(rows)}),
vocabulary AS (SELECT DISTINCT unnest(words) AS x FROM t),
held AS (SELECT r, unnest(list_distinct(w)) AS x FROM d),
rarity AS (
  SELECT x, ln(((SELECT count(*) FROM d) + 1) / (count(r) + 1)) + 1e-9 AS weight
  FROM vocabulary LEFT JOIN held USING (x) GROUP BY x),
able AS (SELECT r, w, t.* FROM d JOIN t ON {" + ".join(has(j) for j in range(1, most + 1))} >= need),
tried AS (SELECT *, unnest(range(-len(words), len(w))) AS off FROM able),
placed AS (SELECT * FROM tried WHERE {" + ".join(key(j) for j in range(1, most + 1))} >= need),
spread AS (SELECT r, k, label, base, off, off + s[1] AS start, w, words, unnest(range(len(words))) AS i FROM placed),
found AS (
  SELECT r, label, base, start,
    sum(CASE WHEN off + i >= 0 AND w[off + i + 1] = words[i + 1] THEN weight ELSE 0 END) / sum(weight) AS share
  FROM spread JOIN rarity ON x = words[i + 1] GROUP BY r, k, label, base, start HAVING share >= {MIN_SHARE}),
told AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(score, 0), 6) AS score
FROM d LEFT JOIN told USING (r)"""
