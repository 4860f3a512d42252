"""License recognition by sentence rules, in DataFrame functions only.

A text is split into sentences (at ``. ! ? : ;`` before white space, and at blank
lines) and each is normalised: lower case, anything but a-z and 0-9 read as one
space.  Sentences of known licences have an identifier; the others are ignored.
A known sentence may begin and end at a line end, too, and may be wrapped: a
line end inside it, with the comment marks of the next line, reads as a space.
If two known sentences begin at one place, the longer one is meant.  A known
sentence whose usual wording has a sentence mark inside (``INNER_END``) is known
with and without it.
A document's identifiers, in order, are matched against rules: a rule is a
licence's sequence of identifiers, which must follow each other without another
known sentence between.  Longer rules go first and use their sentences up, so a
whole licence is not also reported as the short notices inside it.  "All rights
reserved" is reported only where no licence is.

Defined results: null and empty texts have no finding; a licence that occurs
several times is one row with its count; repeated rows and null ids are
documents like others; columns of the input but id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, as normalised text, by identifier.
SENTENCES = {
    "agpl3-notice": "this work is licensed under the gnu affero general public license version 3",
    "all-rights": "all rights reserved",
    "apache-licensed": "licensed under the apache license version 2 0 the license",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-short": "licensed under the apache license version 2 0",
    "apache-specific": "see the license for the specific language governing permissions and limitations under the license",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
                  "and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-conditions": "redistribution and use in source and binary forms with or without modification are permitted "
                      "provided that the following conditions are met",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission",
    "bsd-short": "released under the bsd license",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions "
                  "and the following disclaimer",
    "bsl": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
           "accompanying documentation covered by this license the software to use reproduce display distribute execute "
           "and transmit the software and to prepare derivative works of the software and to permit third parties to whom "
           "the software is furnished to do so all subject to the following",
    "bsl-short": "distributed under the boost software license version 1 0",
    "cc-by-4": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-short": "licensed under cc by nc 4 0",
    "cc-by-sa-short": "licensed under cc by sa 4 0",
    "cc-by-short": "licensed under cc by 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "epl2-http": "this program and the accompanying materials are made available under the terms of the eclipse public "
                 "license 2 0 which is available at http www eclipse org legal epl 2 0",
    "epl2-https": "this program and the accompanying materials are made available under the terms of the eclipse public "
                  "license 2 0 which is available at https www eclipse org legal epl 2 0",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the license "
                "or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even "
                "the implied warranty of merchantability or fitness for a particular purpose",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 2 of the license "
                 "or at your option any later version",
    "gpl2-notice": "this work is licensed under the gnu general public license version 2",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even "
                 "the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                   "lesser general public license as published by the free software foundation either version 2 1 of the "
                   "license or at your option any later version",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the software",
    "mit-short": "released under the mit license",
    "mit-title": "the mit license mit",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications "
                  "and to alter it and redistribute it freely subject to the following restrictions",
    "zlib-origin": "the origin of this software must not be misrepresented you must not claim that you wrote the original "
                   "software",
}

# Licences by their SPDX identifiers.
SPDX = ("AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
        "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT",
        "MPL-2.0", "Unlicense", "Zlib")

# Rule name, licence, sentences in order.
RULES = (
    ("agpl-3.0-notice", "AGPL-3.0-only", ("agpl3-notice",)),
    ("all-rights-reserved", "Proprietary", ("all-rights",)),
    ("apache-2.0-header", "Apache-2.0", ("apache-licensed", "apache-may-not", "apache-obtain", "apache-specific")),
    ("apache-2.0-header-start", "Apache-2.0", ("apache-licensed", "apache-may-not")),
    ("apache-2.0-notice", "Apache-2.0", ("apache-short",)),
    ("apache-2.0-first-sentence", "Apache-2.0", ("apache-licensed",)),
    ("bsd-2-clause", "BSD-2-Clause", ("bsd-conditions", "bsd-source", "bsd-binary")),
    ("bsd-3-clause", "BSD-3-Clause", ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("bsd-notice", "BSD-3-Clause", ("bsd-short",)),
    ("bsl-1.0", "BSL-1.0", ("bsl",)),
    ("bsl-1.0-notice", "BSL-1.0", ("bsl-short",)),
    ("cc-by-4.0", "CC-BY-4.0", ("cc-by-4",)),
    ("cc-by-4.0-notice", "CC-BY-4.0", ("cc-by-short",)),
    ("cc-by-nc-4.0-notice", "CC-BY-NC-4.0", ("cc-by-nc-short",)),
    ("cc-by-sa-4.0-notice", "CC-BY-SA-4.0", ("cc-by-sa-short",)),
    ("cc0-1.0", "CC0-1.0", ("cc0",)),
    ("epl-2.0-notice", "EPL-2.0", ("epl2-https",)),
    ("epl-2.0-notice-http", "EPL-2.0", ("epl2-http",)),
    ("gpl-2.0-header", "GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    ("gpl-2.0-notice", "GPL-2.0-only", ("gpl2-notice",)),
    ("gpl-3.0-header", "GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("gpl-3.0-notice", "GPL-3.0-only", ("gpl3-notice",)),
    ("isc", "ISC", ("isc-grant",)),
    ("lgpl-2.1-header", "LGPL-2.1-or-later", ("lgpl21-free", "lgpl-hope")),
    ("mit", "MIT", ("mit-grant", "mit-notice")),
    ("mit-notice", "MIT", ("mit-short",)),
    ("mit-title", "MIT", ("mit-title",)),
    ("mpl-2.0-notice", "MPL-2.0", ("mpl2",)),
    ("unlicense", "Unlicense", ("unlicense",)),
    ("zlib", "Zlib", ("zlib-grant", "zlib-origin")),
)

# The words before each sentence mark that the usual wording of a known sentence has inside.
INNER_END = {
    "gpl-free": ("this program is free software",),
    "gpl-hope": ("this program is distributed in the hope that it will be useful but without any warranty",),
    "gpl2-free": ("this program is free software",
                  "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation"),
    "lgpl-hope": ("this library is distributed in the hope that it will be useful but without any warranty",),
    "lgpl21-free": ("this library is free software",
                    "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                    "lesser general public license as published by the free software foundation"),
    "mpl2": ("this source code form is subject to the terms of the mozilla public license v",),
    "zlib-origin": ("the origin of this software must not be misrepresented",),
}

# Every identifier is a sentence of its own, after "SPDX-License-Identifier:", and a rule.
_SPDX_HEAD = "spdx license identifier"
SENTENCES |= {f"spdx-{x.lower()}": f"{_SPDX_HEAD} {x.lower().replace('-', ' ').replace('.', ' ')}" for x in SPDX}
RULES += tuple((f"{x.lower()}-spdx", x, (f"spdx-{x.lower()}",)) for x in SPDX)
INNER_END |= {f"spdx-{x.lower()}": (_SPDX_HEAD,) for x in SPDX}
# Reserved rights say nothing beside a licence.
ALONE = "all-rights-reserved"

NUMBER = {name: i for i, name in enumerate(sorted(SENTENCES))}
BY_TEXT = {SENTENCES[name]: i for name, i in NUMBER.items()}
# Longest first; rules of one length by name.
ORDERED = sorted(RULES, key=lambda r: (-len(r[2]), r[0]))

SENTENCE_END = r"([.!?:;])[ \t\r\f]+"
# A line's beginning up to its first word (m4 and batch files mark comments with words).
COMMENT_MARKS = r"\n[^a-z0-9\n]*+(?:(?:dnl|rem)(?![a-z0-9])[^a-z0-9\n]*+)?"
# Each known sentence has one of these words; texts without any are passed over.
HINTS = ("copyright", "free software", "license", "misrepresented", "permission", "redistribution", "reserved",
         "unencumbered", "warranty")


def pattern(rule: tuple) -> str:
    return "".join(f"<{NUMBER[s]}>" for s in rule[2])


def normalised(text: Column) -> Column:
    """Words with a space between them, a newline at a line end, an ``S`` where a sentence ends.

    Lower-case text has no ``S`` of its own.
    """
    out = F.regexp_replace(F.concat(F.lit("\n"), F.lower(text)), COMMENT_MARKS, "\n")
    out = F.regexp_replace(out, SENTENCE_END + r"|[.!?:;](?=\n)|\n\n", "S")
    out = F.regexp_replace(out, r"[^a-z0-9S\n]+", " ")
    out = F.regexp_replace(out, r"[ \n]*+S[S \n]*", "S")
    return F.trim(F.regexp_replace(out, r" ?\n[ \n]*", "\n"))


def known_sentence() -> str:
    """A regular expression for any known sentence, whole, in a normalised text."""
    def one(name: str) -> str:
        words = SENTENCES[name].split(" ")
        heads = [" ".join(words[:i]) for i in range(1, len(words))]
        ends = INNER_END.get(name, ())
        return words[0] + "".join((r"[ \nS]" if h in ends else r"[ \n]") + w for h, w in zip(heads, words[1:]))

    longest_first = sorted(SENTENCES, key=lambda name: -len(SENTENCES[name]))
    return f"(?<![a-z0-9 ])(?:{'|'.join(map(one, longest_first))})(?![a-z0-9 ])"


def sentence_ids(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order."""
    known = F.create_map([F.lit(x) for pair in BY_TEXT.items() for x in pair])
    found = F.regexp_extract_all(normalised(text), F.lit(known_sentence()), F.lit(0))
    return F.transform(found, lambda s: F.element_at(known, F.translate(s, "S\n", "  ")))


def marks(ids: Column) -> Column:
    """The identifier sequence as text, rules replaced by their marks, longest first."""
    out = F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit("<"), i.cast("string"), F.lit(">"))))
    for n, rule in enumerate(ORDERED):
        out = F.replace(out, F.lit(pattern(rule)), F.lit(f"[{n}]"))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and rule found: id, ``rule``, ``license``, ``n_found``."""
    sequences = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
                 .where(F.col("text").rlike("(?i)" + "|".join(HINTS)))
                 .select("id", sentence_ids(F.col("text")).alias("ids")).where(F.size("ids") > 0)
                 .select("id", marks(F.col("ids")).alias("marks")))
    found = F.array(*[F.struct(F.lit(r[0]).alias("rule"), F.lit(r[1]).alias("license"),
                               F.regexp_count("marks", F.lit(rf"\[{n}\]")).cast("long").alias("n_found"))
                      for n, r in enumerate(ORDERED)])
    hits = F.filter(found, lambda f: f["n_found"] > 0)
    licences = F.filter(hits, lambda f: f["rule"] != ALONE)
    return (sequences.select("id", F.explode(F.when(F.size(licences) > 0, licences).otherwise(hits)).alias("f"))
            .select(F.col("id").alias(id_col), "f.rule", "f.license", "f.n_found"))
