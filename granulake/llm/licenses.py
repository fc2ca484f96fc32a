"""Operator 8: licence scans by sentence rules.

A text is brought to a normal form and its sentences are looked up among known licence
sentences; what remains is a sequence of sentence identifiers. Sentences end at marks,
blank lines, addresses and list numbers, and a
copyright notice ends where a licence's first words follow. A line end, colon or semicolon may end one or
lie inside it, so wrapped and one-line forms give the same identifiers; of several known
sentences that start at one place the longest counts. Signs, list marks and `dnl` or
`rem` at the start of a line are dropped, and holders named inside BSD sentences do not matter. Ordered rules, most specific first, each name a licence and the
identifiers that follow one another in it; a rule takes what it matches out of the
sequence, so a shorter rule does not match the same sentences again. Any other sentence
between two known ones parts them, so an added clause is not overlooked; copyright lines,
list numbers and addresses are no sentences. Identifiers no rule takes make the result UNKNOWN.

All of it is an expression on the row: nothing is shuffled, and the tables are
fixed values, far below any broadcast limit.

Null and empty texts: no identifiers, no licences, verdict NONE. Repeated rows:
each its own result. Very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence sentences in normal form, from the texts of public licences.
SENTENCES = {
    "mit-release": "released under the mit license",
    "mit-name": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "no-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache-2-name": "licensed under the apache license version 2.0",
    "apache-2-long": "licensed under the apache license version 2.0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-3-name": "this work is licensed under the gnu general public license version 3",
    "gpl-3-short": "licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "bsd-redistribute": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-name": "licensed under the bsd license",
    "cc-by-4": "licensed under cc by 4.0",
    "cc-by-sa-4": "licensed under cc by sa 4.0",
    "cc-by-nc-4": "licensed under cc by nc 4.0",
    "cc-by-nc-4-work": "this work is licensed under cc by nc 4.0",
    "mpl-2-subject": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "all-rights": "all rights reserved",
    "mpl-2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "gpl-2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl-2-name": "this work is licensed under the gnu general public license version 2",
    "gpl-2-short": "licensed under the gnu general public license version 2",
    "lgpl-2.1-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version",
    "lgpl-3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-3-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "lgpl-copy": "you should have received a copy of the gnu lesser general public license along with this library",
    "lgpl-copy-program": "you should have received a copy of the gnu lesser general public license along with this program",
    "agpl-3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-see": "see the gnu affero general public license for more details",
    "agpl-copy": "you should have received a copy of the gnu affero general public license along with this program",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-no-liability": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-no-liability": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "asf-agreements": "licensed to the apache software foundation asf under one or more contributor license agreements",
    "asf-notice": "see the notice file distributed with this work for additional information regarding copyright ownership",
    "asf-licenses": "the asf licenses this file to you under the apache license version 2.0 the license",
    "gpl-3-only-of": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 3 of the license",
    "gpl-3-only-as": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 3",
    "gpl-3-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "gpl-2-only-of": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2 of the license",
}

#: Licence and the identifiers that follow one another in it, tried in this order.
RULES = [
    *(
        (name, [*all_rights, "bsd-redistribute", *clauses, *ending])
        for name, clauses in (("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse"]), ("BSD-2-Clause", ["bsd-source", "bsd-binary"]))
        for ending in (["bsd-as-is", "bsd-no-liability"], ["bsd-as-is"], [])
        for all_rights in (["all-rights"], [])
    ),
    *(
        (name, [first, hope, see, copy][:n])
        for name, first, hope, see, copy in (
            ("GPL-3.0-or-later", "gpl-free", "gpl-hope", "gpl-see", "gpl-copy"),
            ("GPL-2.0-or-later", "gpl-2-free", "gpl-hope", "gpl-see", "gpl-copy"),
            ("GPL-2.0-only", "gpl-2-only", "gpl-hope", "gpl-see", "gpl-copy"),
            ("GPL-2.0-only", "gpl-2-only-of", "gpl-hope", "gpl-see", "gpl-copy"),
            ("GPL-3.0-only", "gpl-3-only-of", "gpl-hope", "gpl-see", "gpl-copy"),
            ("GPL-3.0-only", "gpl-3-only-as", "gpl-hope", "gpl-see", "gpl-copy"),
            ("GPL-3.0-only", "gpl-3-only", "gpl-hope", "gpl-see", "gpl-copy"),
            ("LGPL-2.1-or-later", "lgpl-2.1-free", "lgpl-hope", "lgpl-see", "lgpl-copy"),
            ("LGPL-3.0-or-later", "lgpl-3-free", "lgpl-hope", "lgpl-see", "lgpl-copy"),
            ("LGPL-3.0-or-later", "lgpl-3-program", "gpl-hope", "lgpl-see", "lgpl-copy-program"),
            ("AGPL-3.0-or-later", "agpl-3-free", "gpl-hope", "agpl-see", "agpl-copy"),
        )
        for n in (4, 3, 2, 1)
        if first != "gpl-free" or n == 4
    ),
    *(("Apache-2.0", [*before, "asf-licenses", "apache-comply", "apache-copy", "apache-as-is", "apache-see"][:n]) for before in (["asf-agreements", "asf-notice"], []) for n in (7, 5, 3, 1) if n > len(before)),
    ("ISC", ["isc-grant", "isc-as-is", "isc-no-liability"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant"]),
    ("MPL-2.0", ["mpl-2-subject", "mpl-2-copy"]),
    ("GPL-2.0-only", ["gpl-2-name"]),
    ("GPL-2.0-only", ["gpl-2-short"]),
    ("Unlicense", ["unlicense"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is", "no-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-release"]),
    ("MIT", ["mit-name"]),
    ("Apache-2.0", ["apache-2-long", "apache-comply", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-2-long", "apache-comply", "apache-copy"]),
    ("Apache-2.0", ["apache-2-long"]),
    ("Apache-2.0", ["apache-2-name"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-3.0-only", ["gpl-3-name"]),
    ("GPL-3.0-only", ["gpl-3-short"]),
    ("BSD", ["bsd-redistribute"]),
    ("BSD", ["bsd-name"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-work"]),
    ("MPL-2.0", ["mpl-2-subject"]),
    ("all-rights-reserved", ["all-rights"]),
]

#: Licences that an identifier line names, each as a sentence and a rule of its own.
for licence in ["MIT", "Apache-2.0", "ISC", "MPL-2.0", "Unlicense", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"] + [
    f"{name}-{which}" for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for which in ("only", "or-later")
]:
    SENTENCES[f"spdx-{licence.lower()}"] = f"spdx license identifier {licence.lower().replace('-', ' ')}"
    RULES.append((licence, [f"spdx-{licence.lower()}"]))

#: In a sequence: any sentence that is not known.
OTHER = "~"
#: No sentences: what has no word, and copyright lines.
NO_SENTENCE = "^(?!.*[a-z]{3})|^(?:portions )?(?:copyright|c) "

#: Signs of the normal form: the end of a sentence, and a place where one may end or go on.
END, MAYBE = "\x01", "\x02"
AFTER = "[\"'”’)\\]}*/]*+(?=[ \\t\\n\\x0b\\f]|\\z)"
GAP = f"[ {MAYBE}]++"


def gapped(words: str) -> str:
    return words.replace(" ", GAP)


#: Names of holders inside licence sentences, and the words that stand for them.
HOLDERS = [
    ("neither the name of", "nor the names of its contributors", "the copyright holder"),
    ("this software is provided by", "as is and any express or implied", "the copyright holders and contributors"),
    ("in no event shall", "be liable for any direct indirect incidental special exemplary", "the copyright holder or contributors"),
]
#: What may follow a copyright notice that no mark ends.
OPENINGS = [
    "permission is hereby granted free of charge", "permission to use copy modify", "licensed under the", "this work is licensed under", "released under the",
    "redistribution and use in source and binary forms", "all rights reserved", "this program is free software", "this library is free software",
    "this source code form is subject to",
]


def normal(text: Column) -> Column:
    """Lower case, runs of other characters as one space, and signs where sentences end or may end."""
    plain = F.translate(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "\r\n?", "\n"), END + MAYBE, "  ")
    steps = [
        ("https?://[^ \\t\\n\\x0b\\f<>\"]++", END),
        ("(?md)^[^a-z0-9\\n(]++", ""),  # signs of comments and lists
        ("(?md)^(?:dnl|rem)[ \\t]++", ""),
        ("(?<![^ \\t\\n])\\((?:[0-9]{1,2}|[abd-hj-z]|[ivx]{1,4})\\)(?=[ \\t\\n])", END),
        ("(?md)^[a-z][.)][ \\t]++", END),
        ("(?md)^[0-9]{1,2}\\)[ \\t]++", END),
        (f"(?<![.!?])(?<!\\bv)[.!?][.!?:;]*+{AFTER}", END),
        (f"(?<![:;])[:;]++{AFTER}", MAYBE),
        (f"[^a-z0-9.\n{END}{MAYBE}]++", " "),
        ("\n ?\n[ \n]*+", END),
        ("\n", MAYBE),
    ]
    for sought, put in steps:
        plain = F.regexp_replace(plain, sought, put)
    plain = F.regexp_replace(plain, f"(copyright[^{END}]{{0,200}}?) (?={'|'.join(gapped(o) for o in OPENINGS)})", f"$1{MAYBE}")
    for before, after, holder in HOLDERS:
        some = f"({gapped(before)}{GAP}).{{1,100}}?({GAP}{gapped(after)})"
        plain = F.regexp_replace(plain, "(?s)" + some, f"$1{holder}$2")
    return plain


def all_sentences(text: Column) -> Column:
    """The sentences of a text in order: known ones whole, others as they are cut."""
    longest = sorted(SENTENCES.values(), key=len, reverse=True)
    each = "|".join(gapped(s.replace(".", "\\.")) for s in longest)
    cut = f"[{END}{MAYBE}]"
    some = f"(?<=^ ?|{cut} ?)(?:(?:{each})(?= ?(?:{cut}|\\z))|[a-z0-9.][^{END}{MAYBE}]*+)"
    found = F.regexp_extract_all(normal(text), F.lit(some), F.lit(0))
    return F.transform(found, lambda s: F.regexp_replace(s, GAP, " "))


def take(state: Column, rule: Column) -> Column:
    """One rule's step: take its identifiers out of the rest and note its licence."""
    rest = F.replace(state["rest"], rule["sought"], F.lit("|"))
    taken = F.struct(rest.alias("rest"), F.array_append(state["names"], rule["name"]).alias("names"))
    return F.when(F.contains(state["rest"], rule["sought"]), taken).otherwise(state)


def scan(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Id, sentence identifiers in order, licences in rule order, and the verdict of each text."""
    known = F.create_map(*[F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)])
    name = lambda s: F.coalesce(known[s], F.when(~F.rlike(s, F.lit(NO_SENTENCE)), F.lit(OTHER)))
    sequence = F.filter(F.transform(all_sentences(F.col(text)), name), lambda x: x.isNotNull())
    found = docs.select(F.col(id), sequence.alias("sequence"))
    found = found.withColumn("sentence_ids", F.filter("sequence", lambda x: x != OTHER))

    # a sequence is text with a bar on either side of each identifier: |a||b|
    start = F.concat_ws("", F.transform("sequence", lambda x: F.concat(F.lit("|"), x, F.lit("|"))))
    state = F.struct(start.alias("rest"), F.array().cast("array<string>").alias("names"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{i}|" for i in ids)).alias("sought")) for name, ids in RULES])
    state = F.aggregate(rules, state, take)
    nothing = F.struct(F.lit("").alias("rest"), F.array().cast("array<string>").alias("names"))
    matched = found.withColumn("state", F.when(F.size("sentence_ids") > 0, state).otherwise(nothing))
    names = F.array_distinct("state.names")
    left = F.translate("state.rest", f"|{OTHER}", "") != ""
    verdict = F.when(F.size("sentence_ids") == 0, "NONE").when(left | (F.size(names) == 0), "UNKNOWN").otherwise(F.array_join(names, " AND "))
    return matched.select(id, "sentence_ids", names.alias("licenses"), verdict.alias("verdict"))
