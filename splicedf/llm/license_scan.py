"""License scans: sentences to known licence sentences, and their sequences to ordered licence rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splicedf.llm.common import ascii_lower, renamed

#: Known licence sentences, normalised (lower case, what is not a-z or 0-9 as one space), by identifier.
SENTENCES = {
    "mit-ref": ["released under the mit license", "licensed under the mit license", "this software is released under the mit license", "this project is licensed under the mit license", "mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "apache2-ref": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license"],
    "apache2-may-not": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at"],
    "gpl3-ref": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl-received": ["you should have received a copy of the gnu general public license along with this program"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-name": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "mpl2-ref": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "cc-by-ref": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa-ref": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc-ref": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc0-ref": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "reserved": ["all rights reserved"],
}
#: Licence, its class and its sequence of sentences; the first that matches takes its sentences.
RULES = (
    ("MIT", "permissive", ("mit-ref", "mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", "permissive", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", "permissive", ("mit-grant", "mit-notice")),
    ("Apache-2.0", "permissive", ("apache2-ref", "apache2-may-not", "apache2-copy")),
    ("Apache-2.0", "permissive", ("apache2-ref", "apache2-may-not")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-hope", "gpl-received")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-hope")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free", "gpl-hope", "gpl-received")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free", "gpl-hope")),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", "permissive", ("mit-ref",)),
    ("Apache-2.0", "permissive", ("apache2-ref",)),
    ("GPL-3.0-only", "copyleft", ("gpl3-ref",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free",)),
    ("ISC", "permissive", ("isc-grant",)),
    ("MPL-2.0", "copyleft", ("mpl2-ref",)),
    ("CC-BY-NC-4.0", "noncommercial", ("cc-by-nc-ref",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa-ref",)),
    ("CC-BY-4.0", "permissive", ("cc-by-ref",)),
    ("CC0-1.0", "public-domain", ("cc0-ref",)),
    ("Unlicense", "public-domain", ("unlicense",)),
    ("LicenseRef-reserved", "reserved", ("reserved",)),
)
#: Of the SQL alone: its prefilter, and a line that goes on (no sentence ends before the line feed, a small letter follows).
HINT = "(?i)licen|permission|warrant|redistribut|copyright|free software|general public|rights reserved"
WRAPPED = "([^.!?;:|\\n])\\n([a-z])"
#: The longest word of each sentence: a text without any of them holds no known sentence.
WORDS = sorted({max(s.split(), key=len) for of in SENTENCES.values() for s in of})
ANY_WORD = "(?i)" + "|".join(WORDS)
SENTENCE_END = "[.!?;:]+[ \\t\\r\\n]+"
#: A known sentence from one break to another, the longest first; between its words there may be breaks.
KNOWN = "(?<=\\n)(?:" + "|".join(s.replace(" ", "[ \\n]") for s in sorted((s for of in SENTENCES.values() for s in of), key=len, reverse=True)) + ")(?=\\n)"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in its order; other sentences are left out.

    Line feeds and ends of sentences are breaks. A known sentence starts and ends at one and may run over others, so
    wrapped lines count whatever they begin with; comment marks and indentation are no letters and fall away.
    """
    known = F.create_map(*[F.lit(x) for i, of in SENTENCES.items() for s in of for x in (s, i)])
    plain = F.regexp_replace(ascii_lower(F.regexp_replace(text, SENTENCE_END, "\n")), "[^a-z0-9\\n]+", " ")
    broken = F.regexp_replace(F.concat(F.lit("\n"), plain, F.lit("\n")), " ?\\n[ \\n]*", "\n")
    return F.transform(F.regexp_extract_all(broken, F.lit(KNOWN), F.lit(0)), lambda s: known[F.translate(s, "\n", " ")])


def licensed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with sentence_ids and licenses (comma-joined), license_class and n_licenses.

    Rules are tried in order on the sequence of identifiers; a rule that matches takes the sentences of its first match
    away from later rules and counts once. license_class is that of the first rule that matched; without any, it is
    'none'. Null and empty texts have no sentences; of rules that could match alike the first in the list counts; repeated
    rows are judged alike and very long texts whole. Columns of docs pass through, but for those of the four names above,
    which are replaced. Every document is judged within its row: nothing is shuffled.
    """
    d, cols = renamed(docs)
    text = F.coalesce(F.col(f"c{cols.index(text_col)}"), F.lit(""))
    d = d.withColumn("_seq", F.when(text.rlike(ANY_WORD), F.concat(F.lit(">"), F.array_join(sentence_ids(text), ">>"), F.lit(">"))).otherwise(">>"))
    d = d.withColumn("sentence_ids", F.regexp_replace(F.regexp_replace("_seq", ">>", ","), ">", ""))
    d = d.withColumns({"sentence_ids": F.trim(F.regexp_replace("sentence_ids", "^,$", "")), "_left": F.col("_seq")})
    names, kinds = [], []
    for i, (name, kind, ids) in enumerate(RULES):
        want = ">" + ">>".join(ids) + ">"
        at = F.locate(want, F.col("_left"))
        d = d.withColumn(f"_m{i}", at > 0).withColumn("_left", F.when(at > 0, F.concat(F.substring("_left", F.lit(1), at - 1), F.lit("<"), F.substring("_left", at + len(want), F.lit(1 << 30)))).otherwise(F.col("_left")))
        names.append(F.when(F.col(f"_m{i}"), F.lit(name)))
        kinds.append(F.when(F.col(f"_m{i}"), F.lit(kind)))
    found = F.array_distinct(F.filter(F.array(*names), lambda x: x.isNotNull()))
    d = d.withColumns({"licenses": F.array_join(found, ","), "license_class": F.coalesce(*kinds, F.lit("none")), "n_licenses": F.size(found).cast("long")})
    made = ("sentence_ids", "licenses", "license_class", "n_licenses")
    return d.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols) if c not in made], *made)
