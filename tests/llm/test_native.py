"""Chat formatting and license scans: unit cases, and plans without Python."""

import textwrap

import pytest

from campaignlake.llm import chat_format as cf
from campaignlake.llm import license_scan as ls
from campaignlake.llm import queries

from .util import SF, empty_documents, odd_documents


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op6_preference_format", "op9_license_scan"])
def test_no_python_in_the_plan(spark, name):
    plan = physical(queries.QUERIES[name](spark, SF))
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct"))


# --- chat -------------------------------------------------------------------

TURNS = "conv_id long, turn int, role string, text string"


def pairs(spark, chosen, rejected):
    return {r["conv_id"]: r for r in cf.format_preferences(
        spark.createDataFrame(chosen, TURNS), spark.createDataFrame(rejected, TURNS)).collect()}


def test_prompt_completions_and_masks(spark):
    base = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi <|im_end|> 🙂")]
    got = pairs(spark, [*base, (1, 2, "assistant", "Hello!"), (1, 3, "user", "Thanks"), (1, 4, "assistant", "Bye")],
                [(1, 2, "assistant", "No."), *reversed(base)])[1]
    assert got["n_prompt_turns"] == 2
    assert got["prompt"] == ("<|im_start|>system\nBe kind.<|im_end|>\n"
                             "<|im_start|>user\nHi < |im_end|> 🙂<|im_end|>\n")
    assert got["rejected"] == "<|im_start|>assistant\nNo.<|im_end|>\n"
    learned = [got["chosen"][s["start"]:s["stop"]] for s in got["chosen_mask"]]
    assert learned == ["Hello!<|im_end|>", "Bye<|im_end|>"]
    assert [got["rejected"][s["start"]:s["stop"]] for s in got["rejected_mask"]] == ["No.<|im_end|>"]


def test_chat_odd_input(spark):
    got = pairs(spark, [(1, 0, "user", "a"), (2, 0, None, None), (2, 0, None, None), (2, None, "user", "x"),
                        (None, 0, "user", "lost"), (3, 0, "user", "same"), (5, 0, "user", "a"), (5, 1, "assistant", "b")],
                [(2, 0, "user", ""), (3, 0, "user", "same"), (4, 1, "assistant", "only here"), (5, 0, "user", "a")])
    assert got.keys() == {1, 2, 3, 4, 5}
    assert got[1]["prompt"] == got[1]["rejected"] == "" and got[1]["chosen"] and got[1]["chosen_mask"] == []
    assert got[2]["n_prompt_turns"] == 0 and got[2]["chosen"].count("<|im_start|>") == 3
    assert got[3]["n_prompt_turns"] == 1 and got[3]["chosen"] == got[3]["rejected"] == ""
    assert got[4]["chosen"] == "" and len(got[4]["rejected_mask"]) == 1
    assert got[5]["n_prompt_turns"] == 1 and got[5]["rejected"] == "" and got[5]["chosen_mask"]
    assert pairs(spark, [], []) == {}


def test_two_sides_part_at_a_turn_and_lose_none(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c} says {t}") for c in range(30) for t in range(1 + c % 7)]
    table = spark.createDataFrame(rows, TURNS)
    got = {r["conv_id"]: r for r in cf.format_preferences(*queries.two_sides(table)).collect()}
    assert got.keys() == set(range(30))
    several = 0
    for c, r in got.items():
        n, place = 1 + c % 7, (c * 7919 + 17) % (1 + c % 7)
        sides = [r["prompt"] + r["chosen"], r["prompt"] + r["rejected"]]
        assert [s.count("<|im_start|>") for s in sides] == [n * (c % 10 != 1), n * (c % 10 != 2)]
        if c % 10 not in (1, 2):
            replies = [t for t in range(n) if t % 2 and t >= place]
            assert r["n_prompt_turns"] == (replies[0] if replies else n)
            assert len(r["rejected_mask"]) == len(replies)
            several += len(replies) > 1
    assert several


# --- licenses ---------------------------------------------------------------

def findings(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["rule"]): r["n_found"] for r in ls.scan(docs).collect()}


def written(*names):
    """Known sentences as a file might have them: other case, spacing and marks."""
    return "\n# ".join(ls.SENTENCES[n].title().replace(" The ", "  the, ") + "." for n in names)


def test_rules_name_known_sentences_once():
    assert {s for r in ls.RULES for s in r[2]} == ls.SENTENCES.keys()
    assert len({r[0] for r in ls.RULES}) == len(ls.RULES) and len({r[2] for r in ls.RULES}) == len(ls.RULES)
    assert len(ls.BY_TEXT) == len(ls.SENTENCES)


def test_every_rule_is_found_alone(spark):
    got = findings(spark, *(written(*r[2]) for r in ls.RULES))
    assert got == {(i, r[0]): 1 for i, r in enumerate(ls.RULES)}


def test_order_matters_and_longer_rules_go_first(spark):
    bsd = ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-endorse")
    got = findings(
        spark, written(*bsd), written(*bsd[:3]) + "\nProse between.\n" + written("bsd-endorse"), written(*reversed(bsd)),
        "Text.\nReleased under the MIT License. More text; all rights reserved.\nReleased under the MIT License.",
        written("bsd-conditions", "mit-short", "bsd-source", "bsd-binary"))
    assert got == {(0, "bsd-3-clause"): 1, (1, "bsd-3-clause"): 1, (3, "mit-notice"): 2, (4, "mit-notice"): 1}


def test_license_odd_input(spark):
    assert ls.scan(odd_documents(spark)).collect() == []
    assert ls.scan(empty_documents(spark)).collect() == []


# What each licence and notice says, in its own punctuation, by rule.
ORIGINALS = {
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "all-rights-reserved": "Copyright (c) 2020 A. Person. All rights reserved.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
                         "in compliance with the License. You may obtain a copy of the License at\n\n"
                         "    http://www.apache.org/licenses/LICENSE-2.0\n\n"
                         "Unless required by applicable law or agreed to in writing, software distributed under the "
                         'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
                         "either express or implied. See the License for the specific language governing permissions "
                         "and limitations under the License.",
    "apache-2.0-header-start": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
                               "file except in compliance with the License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-first-sentence": 'Licensed under the Apache License, Version 2.0 (the "License").',
    "bsd-notice": "Released under the BSD license.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring "
               "rights to this work.",
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.\n\nThis program is distributed in the hope that "
                      "it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
                      "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           'documentation files (the "Software"), to deal in the Software without restriction, including without '
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
           "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
           "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
           "substantial portions of the Software.",
    "mit-notice": "Released under the MIT License.",
    "mit-title": "The MIT License (MIT)\n\nCopyright (c) 2020 A. Person",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                      "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
ORIGINALS["gpl-2.0-header"] = ORIGINALS["gpl-3.0-header"].replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")
ORIGINALS["lgpl-2.1-header"] = (
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
    "any later version.\n\nThis library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General "
    "Public License for more details.")
ORIGINALS["bsl-1.0"] = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
    "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
    "Software is furnished to do so, all subject to the following:")
ORIGINALS["bsl-1.0-notice"] = "Distributed under the Boost Software License, Version 1.0."
for scheme, rule in (("https", "epl-2.0-notice"), ("http", "epl-2.0-notice-http")):
    ORIGINALS[rule] = ("This program and the accompanying materials are made available under the terms of the Eclipse "
                       f"Public License 2.0 which is available at {scheme}://www.eclipse.org/legal/epl-2.0/")
ORIGINALS["unlicense"] = "This is free and unencumbered software released into the public domain."
ORIGINALS["zlib"] = (
    "This software is provided 'as-is', without any express or implied warranty.\n\nPermission is granted to anyone to use "
    "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
    "to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that "
    "you wrote the original software.")
ORIGINALS |= {f"{x.lower()}-spdx": f"SPDX-License-Identifier: {x}" for x in ls.SPDX}
ORIGINALS["bsd-2-clause"] = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution.")
ORIGINALS["bsd-3-clause"] = ORIGINALS["bsd-2-clause"] + (
    "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")


def test_every_rule_is_found_in_its_licences_own_punctuation(spark):
    assert ORIGINALS.keys() == {r[0] for r in ls.RULES}
    got = findings(spark, *ORIGINALS.values())
    assert got == {(i, name): 1 for i, name in enumerate(ORIGINALS)}


def test_reserved_rights_say_nothing_beside_a_licence(spark):
    got = findings(spark, "Copyright (c) 2020, A. Person\nAll rights reserved.\n\n" + ORIGINALS["bsd-2-clause"],
                   "All rights reserved. " * 3)
    assert got == {(0, "bsd-2-clause"): 1, (1, "all-rights-reserved"): 3}


def test_licences_in_repeated_long_and_unnumbered_documents(spark):
    text = "filler words. " * 40_000 + "\n" + ORIGINALS["mit"] + "\n" + "more words. " * 40_000
    docs = spark.createDataFrame([(1, text), (1, text), (None, ORIGINALS["isc"])], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["rule"], r["n_found"]) for r in ls.scan(docs).collect()), key=str)
    assert got == sorted([(1, "mit", 1), (1, "mit", 1), (None, "isc", 1)], key=str)


def test_a_sentence_mark_inside_a_sentence_only_where_its_wording_has_one(spark):
    got = findings(spark, "SPDX-License-Identifier: MIT OR Apache-2.0", "Released under the MIT. License.",
                   "/* SPDX-License-Identifier: MIT */", "See SPDX-License-Identifier: MIT",
                   "Licensed under the Apache License, Version 2.0. The License: see below.")
    assert got == {(2, "mit-spdx"): 1, (4, "apache-2.0-notice"): 1}


@pytest.mark.parametrize("first, mark, end", [
    ("", "", "\n"), ("", "", "\r\n"), ("# ", "# ", "\n"), ("// ", "// ", "\r\n"), ("/* ", " * ", "\n"), (";; ", ";; ", "\n"),
    ("! ", "! ", "\n"), (": ", ": ", "\n"), ("dnl ", "dnl ", "\n"), ("REM ", "REM ", "\r\n"), ("<!-- ", "", " \n")])
@pytest.mark.parametrize("width", [30, 72])
def test_every_rule_is_found_in_wrapped_licences(spark, width, first, mark, end):
    def wrapped(text):
        blocks = [textwrap.wrap(b, width, break_long_words=False, break_on_hyphens=False) for b in text.split("\n\n")]
        lines = [line for block in blocks for line in [*block, ""]]
        return first + end.join([lines[0], *(mark + line for line in lines[1:])])

    got = findings(spark, *map(wrapped, ORIGINALS.values()))
    assert got == {(i, name): 1 for i, name in enumerate(ORIGINALS)}


def test_pieces_of_a_sentence_are_joined_over_line_ends_only(spark):
    got = findings(spark, "Released under the\n\nMIT License.", "Released under the\n# \n# MIT License.",
                   "Released under the.\nMIT License.", "Not released under the\nMIT License.",
                   "Released under the\nMIT License of old.", "Licensed under the Apache License, Version 2.0.\nThe License",
                   "Licensed under the Apache License, Version 2.0\n\nThe License", "prose\nReleased under\nthe MIT License\nprose")
    assert got == {(5, "apache-2.0-notice"): 1, (6, "apache-2.0-notice"): 1, (7, "mit-notice"): 1}


def test_inner_ends_and_hints_fit_the_known_sentences():
    assert all(ls.SENTENCES[n].startswith(head + " ") for n, heads in ls.INNER_END.items() for head in heads)
    assert all(any(h in s for h in ls.HINTS) for s in ls.SENTENCES.values())
