"""License scans by sentence rules.

A text is cut into sentences, each sentence is normalised (lower case, every run
of other characters than letters and digits is one blank) and looked up in a
catalogue of known licence sentences. The identifiers found, in order, are one
string per document; a rule is an ordered sequence of identifiers and matches
where its identifiers follow one another. Longer rules are tried first and use
up what they match, so the three-clause text is not also reported as the
two-clause one.

The rules of the query (and its SQL) end a sentence at every line break and know one-line
notices. ``wrapped`` scans whole licence texts: wrapped lines are joined, and the catalogue
has their sentences in full.

Everything is column expressions on one row: no join, no shuffle, no Python. The
catalogue is a literal map that does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: public licence sentences, normalised ------------------------
SENTENCES: dict[str, str] = {
    "licensed under the apache license version 2 0": "apache-grant",
    "licensed under the apache license version 2 0 the license": "apache-grant",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at": "apache-copy",
    "released under the mit license": "mit-grant",
    "licensed under the mit license": "mit-grant",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-permission",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied": "as-is",
    "this work is licensed under the gnu general public license version 3": "gpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "either version 2 of the license or at your option any later version": "gpl2-later",
    "licensed under cc by nc 4 0": "cc-by-nc-grant",
    "licensed under cc by 4 0": "cc-by-grant",
    "licensed under cc by sa 4 0": "cc-by-sa-grant",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-use",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-grant",
    "all rights reserved": "reserved",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
}
# --- fixed values: rules, longest first ------------------------------------------
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("Apache-2.0", ("apache-grant", "apache-compliance", "apache-copy")),
    ("BSD-2-Clause", ("bsd-use", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-permission", "mit-notice", "as-is")),
    ("GPL-3.0-or-later", ("gpl-terms", "gpl3-later")),
    ("GPL-2.0-or-later", ("gpl-terms", "gpl2-later")),
    ("MIT", ("mit-permission", "mit-notice")),
    ("Apache-2.0", ("apache-grant",)),
    ("MIT", ("mit-grant",)),
    ("GPL-3.0", ("gpl3-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-grant",)),
    ("CC-BY-4.0", ("cc-by-grant",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-grant",)),
    ("MPL-2.0", ("mpl2-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    ("all-rights-reserved", ("reserved",)),
]

#: A sentence ends at a line break or at . ! ? ; or : before white space or the end.
SENTENCE_END = r"[.!?;:]+([ \t\r\n]|$)|[\r\n]"
#: Only sentences with one of these can be in the catalogue; the others are not normalised.
HINT = "licen|permission|copyright|software|rights|redistribution|version"

# --- fixed values: sentences and rules of whole texts, as they stand with wrapped lines joined ---
TEXT_SENTENCES: dict[str, str] = SENTENCES | {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-permission",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-terms-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-terms-later",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-grant",
}
TEXT_RULES: list[tuple[str, tuple[str, ...]]] = [
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "gpl3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "gpl2-later")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms-later")),
    *RULES,
]
#: With wrapped lines joined a sentence ends at a blank line (one with a comment mark only is blank) or at . ! ? ; or : before white space or the end.
TEXT_SENTENCE_END = r"[.!?;:]+(?=[ \t\r\n]|$)|\n[ \t\r]*[*#/;-]*[ \t\r]*(?=\n)"


def _normal(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _slug(text: Column) -> Column:
    return F.concat(F.lit("<"), text, F.lit(">"))


def scan_licenses(docs: DataFrame, text: str = "text", wrapped: bool = False) -> DataFrame:
    """The documents with ``n_sentences``, ``sentence_ids``, ``licenses`` and ``n_unmatched``.

    ``sentence_ids`` are the known sentences in order, ``licenses`` the rules that
    matched, each once, in alphabetical order, and ``n_unmatched`` counts known
    sentences that no rule used. Lists are comma-joined. A null or empty text has
    no sentences: 0, "", "", 0. Input columns with these names are replaced, all
    others pass through, and equal rows stay as many rows. ``wrapped`` joins wrapped
    lines and knows the sentences of whole licence texts.
    """
    sentences, rules = (TEXT_SENTENCES, TEXT_RULES) if wrapped else (SENTENCES, RULES)
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    if wrapped:
        parts = F.filter(F.split(body, TEXT_SENTENCE_END), lambda s: s.rlike("[^ \\t\\r\\n]"))
    else:
        parts = F.filter(F.split(F.regexp_replace(body, SENTENCE_END, "\n"), "\n"), lambda s: F.btrim(s) != "")
    parts = F.when(body == "", F.array().cast("array<string>")).otherwise(parts)
    likely = F.filter(F.col("_parts"), lambda s: F.lower(s).rlike(HINT))
    ids = F.filter(F.transform(likely, lambda s: F.element_at(known, _normal(s))), lambda i: i.isNotNull())
    steps = docs.withColumn("_parts", parts).withColumn("_ids", ids)
    # the sequence as one string; each rule cuts out what it matches, longest first
    left = F.array_join(F.transform(F.col("_ids"), _slug), "")
    found: list[Column] = []
    steps = steps.withColumn("_left0", left)
    for i, (name, sequence) in enumerate(rules):
        pattern = "".join(f"<{s}>" for s in sequence)
        here = F.col(f"_left{i}")
        found.append(F.when(F.contains(here, F.lit(pattern)), F.lit(name)))
        steps = steps.withColumn(f"_left{i + 1}", F.replace(here, F.lit(pattern), F.lit("|")))
    names = F.array_sort(F.array_distinct(F.filter(F.array(*found), lambda n: n.isNotNull())))
    result = {
        "n_sentences": F.size("_parts").cast("long"),
        "sentence_ids": F.array_join("_ids", ","),
        "licenses": F.array_join(names, ","),
        "n_unmatched": F.regexp_count(F.col(f"_left{len(rules)}"), F.lit("<")).cast("long"),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in result]
    return steps.select(*kept, *[c.alias(n) for n, c in result.items()])


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle() -> str:
    """The same result in DuckDB SQL over ``documents``."""
    keys = ", ".join(map(_quoted, SENTENCES))
    values = ", ".join(map(_quoted, SENTENCES.values()))
    pats = ["".join(f"<{s}>" for s in sequence) for _, sequence in RULES]
    steps = ",\n".join(
        f"r{i + 1} AS MATERIALIZED (SELECT * REPLACE (replace(rest, {_quoted(p)}, '|') AS rest, "
        f"CASE WHEN contains(rest, {_quoted(p)}) THEN list_append(found, {_quoted(n)}) ELSE found END AS found) FROM r{i})"
        for i, (p, (n, _)) in enumerate(zip(pats, RULES))
    )
    return f"""
WITH s AS MATERIALIZED (
  SELECT rowid_, doc_id, list_filter(string_split(regexp_replace(coalesce(text, ''), '[.!?;:]+([ \\t\\r\\n]|$)|[\\r\\n]', chr(10), 'g'), chr(10)), lambda x: trim(x, ' ') <> '') AS parts
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)),
i AS MATERIALIZED (
  SELECT rowid_, doc_id, len(parts) AS n_sentences,
    list_filter(list_transform(parts, lambda x: list_extract(map_extract(map([{keys}], [{values}]),
      trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'), ' ')), 1)), lambda x: x IS NOT NULL) AS ids FROM s),
r0 AS MATERIALIZED (SELECT doc_id, n_sentences, ids, coalesce(array_to_string(list_transform(ids, lambda x: '<' || x || '>'), ''), '') AS rest, CAST([] AS VARCHAR[]) AS found FROM i),
{steps}
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  coalesce(array_to_string(list_sort(list_distinct(found)), ','), '') AS licenses,
  CAST(length(rest) - length(replace(rest, '<', '')) AS BIGINT) AS n_unmatched
FROM r{len(RULES)}"""
