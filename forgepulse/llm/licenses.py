"""Recognise licences by their sentences.

A text is cut into sentences, which are normalised: lower case, and anything but letters,
digits and dots inside versions becomes one space, so that line breaks and comment marks
do not matter. Known licence sentences get an identifier. Rules, in order, then say
which sequence of identifiers is which licence; what a rule has matched is not looked at
again, and a known sentence that no rule wants is reported as such.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forgepulse.llm.common import python_batches, shielded

# A sentence ends at a stop before white space, at a blank line, after a line with a
# licence tag, or with the text. A stop inside a version such as 2.0 does not end it.
SENTENCE_END = re.compile(
    r"(?i:spdx-license-identifier:)[^\n]*|[.!?;](?=\s|$)|\n[ \t\r]*(?=\n)"
)
NOISE = re.compile(r"[^a-z0-9.]+|\.(?![0-9])|(?<![0-9])\.")

# Every sentence below has one of these words; texts without any are not cut.
WORDS = ("licen", "copyright", "permission", "redistribut", "warrant", "spdx", "as is", "dedicate", "endorse")

# Openings and phrases of the licences' own sentences, normalised.
SENTENCES = [
    ("spdx-tag", r"spdx license identifier (?P<name>[a-z0-9. ]+?)$"),
    ("mit-name", r"\b(released|licensed|distributed|available|provided) under the (terms of the )?mit license\b"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit-keep", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose"),
    ("as-is", r"\bsoftware is provided (by .* )?as is\b"),
    ("apache-name", r"\blicensed under the apache license version (?P<version>[0-9.]+)"),
    ("apache-use", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at"),
    ("apache-law", r"unless required by applicable law or agreed to in writing software distributed under the license"),
    ("gpl-name", r"\blicensed under the gnu general public license( as published by .*?)?,? version (?P<version>[0-9.]+)"),
    ("lgpl-name", r"\blicensed under the gnu lesser general public license,? version (?P<version>[0-9.]+)"),
    ("agpl-name", r"\blicensed under the gnu affero general public license,? version (?P<version>[0-9.]+)"),
    ("gpl-free", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license .*?version (?P<version>[0-9.]+)"),
    ("gpl-hope", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-name", r"neither the name of .* may be used to endorse or promote products"),
    ("mpl-name", r"\bsubject to the terms of the mozilla public license v(ersion)? (?P<version>[0-9.]+)"),
    ("cc-name", r"\blicensed under (a |the )?(cc|creative commons) (?P<terms>by( nc)?( sa| nd)?) (?P<version>[0-9.]+)"),
    ("cc0-name", r"\blicensed under (the )?cc0\b|\bdedicated? .* to the public domain\b.*\bcc0\b"),
]
KNOWN = [(name, re.compile(pattern)) for name, pattern in SENTENCES]

# In order: longer sequences first. A name in braces is a part of the last sentence's match.
RULES = [
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "as-is"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-{version}", ["apache-name", "apache-use", "apache-copy", "apache-law"]),
    ("Apache-{version}", ["apache-name"]),
    ("MIT", ["mit-name", "mit-grant", "mit-keep", "as-is"]),
    ("MIT", ["mit-grant", "mit-keep", "as-is"]),
    ("MIT", ["mit-grant", "mit-keep"]),
    ("MIT", ["mit-name"]),
    ("ISC", ["isc-grant", "as-is"]),
    ("ISC", ["isc-grant"]),
    ("GPL-{version}", ["gpl-free", "gpl-hope"]),
    ("GPL-{version}", ["gpl-free"]),
    ("GPL-{version}", ["gpl-name"]),
    ("LGPL-{version}", ["lgpl-name"]),
    ("AGPL-{version}", ["agpl-name"]),
    ("MPL-{version}", ["mpl-name"]),
    ("CC-{terms}-{version}", ["cc-name"]),
    ("CC0-1.0", ["cc0-name"]),
    ("{name}", ["spdx-tag"]),
]

FOUND = "array<struct<license:string,sentences:array<string>,start:int,end:int>>"


def sentences(text: str) -> Iterator[tuple[str, int, int]]:
    """(normalised, start, end) of each sentence that has a letter."""
    start = 0
    for end in [m.end() for m in SENTENCE_END.finditer(text)] + [len(text)]:
        plain = " ".join(NOISE.sub(" ", text[start:end].lower()).split())
        if re.search("[a-z]", plain):
            lead = len(text[start:end]) - len(text[start:end].lstrip())
            yield plain, start + lead, end
        start = end


def recognised(text: str | None) -> list[tuple[str, list[str], int, int]]:
    """(licence, its sentence ids, start, end) in a text, in order of place."""
    low = (text or "").lower()
    if not any(w in low for w in WORDS):
        return []
    ids = []  # (number, consecutive where nothing unknown lies between, id, parts of the match, start, end)
    n = 0
    for plain, start, end in sentences(text):
        for name, parts in known(plain) or [(None, {})]:
            if name is not None:
                ids.append((n, name, parts, start, end))
            n += 1
    return matched(ids)


def known(plain: str) -> list[tuple[str, dict]]:
    """(id, parts) of the known matches of a sentence, apart from each other, in order of
    place. Where matches overlap, the pattern listed first counts."""
    found = []
    for name, pattern in KNOWN:
        for m in pattern.finditer(plain):
            if all(m.end() <= start or end <= m.start() for start, end, _, _ in found):
                found.append((m.start(), m.end(), name, m.groupdict()))
    return [(name, parts) for _, _, name, parts in sorted(found, key=lambda f: f[:2])]


def matched(ids: list[tuple]) -> list[tuple[str, list[str], int, int]]:
    found, taken = [], set()
    for licence, wanted in RULES:
        for at in range(len(ids) - len(wanted) + 1):
            run = ids[at : at + len(wanted)]
            follows = all(b[0] == a[0] + 1 for a, b in zip(run, run[1:], strict=False))
            if [x[1] for x in run] == wanted and follows and not taken.intersection(range(at, at + len(wanted))):
                taken.update(range(at, at + len(wanted)))
                parts = {k: v.upper().replace(" ", "-") for x in run for k, v in x[2].items() if v}
                found.append((at, (licence.format(**parts), wanted, run[0][3], run[-1][4])))
    found += [(i, (f"part:{x[1]}", [x[1]], x[3], x[4])) for i, x in enumerate(ids) if i not in taken]
    return [f for _, f in sorted(found, key=lambda f: f[0])]


@shielded
def scan_licenses(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs`, with `found`: an array of (license, sentences,
    start, end), places in code points, in order; empty without any.

    Known sentences outside a rule are reported as `part:` and their id. A null or empty
    text has nothing. Repeated rows are scanned alike. A column `found` is replaced.
    """
    names = [c for c in docs.columns if c != "found"]
    kept = docs.select(*names)
    schema = T.StructType([*kept.schema.fields, T.StructField("found", T.DataType.fromDDL(FOUND))])

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(
            pa.struct(
                [("license", pa.string()), ("sentences", pa.list_(pa.string())), ("start", pa.int32()), ("end", pa.int32())]
            )
        )
        keys = ("license", "sentences", "start", "end")
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            found = [[dict(zip(keys, f, strict=True)) for f in recognised(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*names, "found"])

    with python_batches(docs.sparkSession):
        return kept.mapInArrow(scan, schema)
