"""Licence scans by sentence rules: known sentences become identifiers, and ordered rules name the licence."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Sentences of public licence texts and notices, normalised (lower case, signs as one space).
SENTENCES = {
    "mit-named": "released under the mit license",
    "mit-named-2": "this project is licensed under the mit license",
    "mit-named-3": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-2": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache-named": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-header-use": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl2-named": "this work is licensed under the gnu general public license version 2",
    "gpl3-named": "this work is licensed under the gnu general public license version 3",
    "gpl2-named-2": "licensed under the gnu general public license version 2",
    "gpl3-named-2": "licensed under the gnu general public license version 3",
    "gpl2-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-named": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-named": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-sa-named": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc0-named": "this work is dedicated to the public domain under cc0 1 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-named": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "lgpl21-later": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-warranty": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "agpl-see": "see the gnu affero general public license for more details",
    "epl2-named": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "mit-readme": "this project is licensed under the mit license see the license file for details",
    "mit-readme-2": "this project is licensed under the mit license see the license md file for details",
    "apache-readme": "this project is licensed under the apache license 2 0 see the license file for details",
    "apache-readme-2": "this project is licensed under the apache license 2 0",
    "apache-readme-3": "licensed under the apache license 2 0",
}
#: Identifiers that a line "SPDX-License-Identifier: ..." may name.
SPDX = (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "EPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
)
SENTENCES |= {f"spdx-{name.lower()}": "spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower()) for name in SPDX}
#: Rules in the order that they are tried; what a rule takes is no longer there for the next.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-title-2", "mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-header", "apache-use", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-header-use", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-header-use", "apache-copy")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-named",)),
    ("Apache-2.0", ("apache-header",)),
    ("GPL-2.0-only", ("gpl2-named",)),
    ("GPL-3.0-only", ("gpl3-named",)),
    ("GPL-2.0-only", ("gpl2-named-2",)),
    ("GPL-3.0-only", ("gpl3-named-2",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-4.0", ("cc-by-named",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-named",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-named",)),
    ("CC0-1.0", ("cc0-named",)),
    ("MPL-2.0", ("mpl-named",)),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-named-2",)),
    ("MIT", ("mit-named-3",)),
    ("LGPL-2.1-or-later", ("lgpl21-later", "lgpl-warranty", "lgpl-see")),
    ("LGPL-2.1-or-later", ("lgpl21-later",)),
    ("LGPL-3.0-or-later", ("lgpl3-later", "gpl-warranty", "lgpl-see")),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("AGPL-3.0-or-later", ("agpl3-later", "gpl-warranty", "agpl-see")),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("EPL-2.0", ("epl2-named",)),
    ("Unlicense", ("unlicense",)),
    ("MIT", ("mit-readme",)),
    ("MIT", ("mit-readme-2",)),
    ("Apache-2.0", ("apache-readme",)),
    ("Apache-2.0", ("apache-readme-2",)),
    ("Apache-2.0", ("apache-readme-3",)),
    *((name, (f"spdx-{name.lower()}",)) for name in SPDX),
)

#: White space from here on is "H" where a sentence ends for certain, at a sign or a blank line (signs alone are blank too),
#: and "S" where it may end or go on: at ; or : and at a line feed, with the comment leader that follows it. "v. 2" is no end.
#: A run of signs is entered at its first sign only, so that its length counts once.
HARD_END = r"\n[^a-z0-9\n]*+\n[^a-z0-9]*+|(?<![.!?;:])(?:(?<!\bv)|(?!\.\s+[0-9]))[;:]*+[.!?][.!?;:]*+(?=[ \t\r\n]|$)"
SOFT_END = r"\n[^a-z0-9\n]*+|(?<![;:])[;:]++(?=[ \t\r\n]|$)"


def normalised(text: Column) -> Column:
    """A text in lower case with its ends marked, before the first word too, and all other signs as one space."""
    hard = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), HARD_END, "H")
    soft = F.regexp_replace(hard, SOFT_END, "S")
    return F.concat(F.lit("H"), F.regexp_replace(soft, r"[^a-z0-9HS]+", " "))


def sentence_pattern(sentences: list[str]) -> str:
    """Matches known sentences between two ends of a normalised text, over soft ends within; the longest is tried first.

    Where a sentence consists of known ones, an end between those parts makes it those parts.
    """
    known = set(sentences)

    def consists(words: tuple[str, ...]) -> bool:
        return " ".join(words) in known or any(" ".join(words[:i]) in known and consists(words[i:]) for i in range(1, len(words)))

    def pattern(sentence: str) -> str:
        words = tuple(sentence.split(" "))
        out = re.escape(words[0])
        for i in range(1, len(words)):
            parts = " ".join(words[:i]) in known and consists(words[i:])
            out += (" " if parts else "[ S]++") + re.escape(words[i])
        return out

    return f"[HS] ?({'|'.join(pattern(s) for s in sorted(known, key=lambda s: (-len(s), s)))})(?= ?[HS]| ?$)"


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", known: dict[str, str] = SENTENCES,
         rules: tuple = RULES) -> DataFrame:
    """(``key``, licenses, sentence_ids) of each row in whose ``text`` a known sentence stands.

    A sentence may be wrapped over lines, also in comments whose leaders are signs, and may stand on lines of
    its own without a sign at its end. ``sentence_ids`` are the identifiers found, in order, repeats too.
    ``licenses`` holds, sorted and once each, the names of the rules whose identifiers follow one another
    there; rules are tried in order and take what they match. Sentences that belong to no rule's sequence
    give no licence. Null and empty texts find nothing; rows that repeat are scanned each. All is done within
    the row, without a shuffle.
    """
    lookup = F.create_map(*[F.lit(x) for n in known for x in (known[n], f"<{n}>")])
    found = F.regexp_extract_all(normalised(F.col(text)), F.lit(sentence_pattern(list(known.values()))), F.lit(1))
    hits = F.transform(found, lambda s: F.element_at(lookup, F.regexp_replace(s, "[ S]+", " ")))
    rows = docs.select(F.col(key), F.array_join(hits, "").alias("_ids")).filter("_ids != ''")
    left, found = F.col("_ids"), []
    for name, sequence in rules:
        joined = "".join(f"<{s}>" for s in sequence)
        found.append(F.when(F.contains(left, F.lit(joined)), F.lit(name)))
        left = F.replace(left, F.lit(joined), F.lit("<>"))
    licenses = F.array_sort(F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull())))
    ids = F.filter(F.split(F.col("_ids"), "[<>]+"), lambda x: x != "")
    return rows.select(key, licenses.alias("licenses"), ids.alias("sentence_ids"))


def scan_sql() -> str:
    """DuckDB SQL for doc_id, licenses (joined by commas) and n_sentences over the table documents."""
    values = ", ".join(f"('<{n}>', '{s}')" for n, s in SENTENCES.items())
    ids = ["".join(f"<{s}>" for s in sequence) for _, sequence in RULES]
    left = [reduce(lambda x, r: f"replace({x}, '{r}', '<>')", ids[:i], "ids") for i in range(len(ids))]
    cases = ", ".join(f"CASE WHEN contains(r{i}, '{ids[i]}') THEN '{RULES[i][0]}' END" for i in range(len(ids)))
    steps = ["SELECT doc_id, n_sentences, ids AS r0 FROM hits"]
    for i in range(1, len(left)):
        steps.append(f"SELECT *, replace(r{i - 1}, '{ids[i - 1]}', '<>') AS r{i} FROM s{i - 1}")
    chain = ", ".join(f"s{i} AS ({step})" for i, step in enumerate(steps))
    return f"""
    WITH known(id, sentence) AS (VALUES {values}),
    parted AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(lower(coalesce(text, '')),
        '[.!?;:]+([ \\t\\r\\n]+|$)|\\n', chr(10), 'g'), '[^a-z0-9\\n]+', ' ', 'g'), chr(10)) AS p FROM documents),
    each_one AS (SELECT doc_id, trim(unnest(p)) AS sentence, generate_subscripts(p, 1) AS place FROM parted),
    hits AS (SELECT doc_id, string_agg(id, '' ORDER BY place) AS ids, count(*) AS n_sentences
        FROM each_one JOIN known USING (sentence) GROUP BY doc_id),
    {chain}
    SELECT doc_id, n_sentences, array_to_string(list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL))), ',') AS licenses
    FROM s{len(steps) - 1}"""
