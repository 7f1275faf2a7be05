"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences (line ends, or ``. ! ? ;`` followed by white space), every
sentence is normalised (A-Z lower-cased, runs of anything but a-z 0-9 become one space) and
looked up among known licence sentences.  The identifiers found, in text order with unknown
sentences skipped, form a sequence; ordered rules replace runs of identifiers by a licence,
the first rule taking its identifiers before the later ones see them.

A known sentence may be wrapped: inside it a line end (with comment marks) counts as a space, and
its lines as one sentence; a blank line always ends it.  Entries that hold a break themselves
(``v. 2.0``) are looked for with it.  The SQL reads every line for itself, so it agrees on texts
without wrapped notices and without such entries.

Defined results: null and empty texts have no sentence and no licence; a sentence without
a-z 0-9 does not count; repeated licences are listed once, sorted; rows are never dropped,
repeated or joined, and input columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from simcat.llm.common import ASCII_LOWER, ASCII_UPPER, table, text_or_empty

# Known licence sentences: identifier, wording (compared after normalisation).
SENTENCES = [
    ("allRights", "All rights reserved"),
    ("spdxMit", "SPDX-License-Identifier: MIT"),
    ("spdxApache", "SPDX-License-Identifier: Apache-2.0"),
    ("spdxGpl2", "SPDX-License-Identifier: GPL-2.0-only"),
    ("spdxGpl2p", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("spdxGpl3", "SPDX-License-Identifier: GPL-3.0-only"),
    ("spdxGpl3p", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("spdxBsd2", "SPDX-License-Identifier: BSD-2-Clause"),
    ("spdxBsd3", "SPDX-License-Identifier: BSD-3-Clause"),
    ("spdxMpl", "SPDX-License-Identifier: MPL-2.0"),
    ("mitRef", "Released under the MIT License"),
    ("mitRef", "Licensed under the MIT License"),
    ("mitRef", "This project is licensed under the MIT License"),
    ("mitRef", "Distributed under the MIT License"),
    ("mitGrant", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     "this software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions:"),
    ("mitNotice", "The above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software"),
    ("mitAsIs", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
     "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
     "PURPOSE AND NONINFRINGEMENT"),
    ("mitLiability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
     "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
     "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("apacheRef", "Licensed under the Apache License, Version 2.0"),
    ("apacheRef", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("apacheRef", "Released under the Apache License, Version 2.0"),
    ("apacheRef", "This project is licensed under the Apache License, Version 2.0"),
    ("apacheComply", "you may not use this file except in compliance with the License"),
    ("apacheCopy", "You may obtain a copy of the License at"),
    ("apacheAsIs", "Unless required by applicable law or agreed to in writing, software distributed "
     "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
     "KIND, either express or implied"),
    ("gpl3Ref", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl3Ref", "Licensed under the GNU General Public License, version 3"),
    ("gpl2Ref", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl2Ref", "Licensed under the GNU General Public License, version 2"),
    ("lgpl3Ref", "Licensed under the GNU Lesser General Public License, version 3"),
    ("agpl3Ref", "Licensed under the GNU Affero General Public License, version 3"),
    ("gplFree2p", "This program is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation; either "
     "version 2 of the License, or (at your option) any later version"),
    ("gplFree", "This program is free software"),
    ("gplTerms2p", "either version 2 of the License, or (at your option) any later version"),
    ("gplTerms3p", "either version 3 of the License, or (at your option) any later version"),
    ("gplTerms", "you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation"),
    ("gplTerms3pOne", "This program is free software: you can redistribute it and/or modify it under "
     "the terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version"),
    ("gplHope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY"),
    ("gplImplied", "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
     "PURPOSE"),
    ("gplSee", "See the GNU General Public License for more details"),
    ("bsdIntro", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("bsdSource", "Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer"),
    ("bsdBinary", "Redistributions in binary form must reproduce the above copyright notice, this list "
     "of conditions and the following disclaimer in the documentation and/or other materials provided "
     "with the distribution"),
    ("bsdEndorse", "Neither the name of the copyright holder nor the names of its contributors may be "
     "used to endorse or promote products derived from this software without specific prior written "
     "permission"),
    ("mplRef", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mplCopy", "If a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/"),
    ("iscGrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("publicDomain", "This work is in the public domain"),
    ("publicDomain", "Released into the public domain"),
    ("ccBy", "Licensed under CC BY 4.0"),
    ("ccBy", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("ccBySa", "Licensed under CC BY-SA 4.0"),
    ("ccBySa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License"),
    ("ccByNc", "Licensed under CC BY-NC 4.0"),
    ("ccByNc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License"),
    ("ccByNcSa", "Licensed under CC BY-NC-SA 4.0"),
    ("ccByNd", "Licensed under CC BY-ND 4.0"),
    ("ccByNcNd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc0", "Licensed under CC0 1.0"),
    ("cc0", "Licensed under CC0 1.0 Universal"),
]

# Ordered rules: licence, sequence of sentence identifiers.  Longer sequences come first.
RULES = [
    ("MIT", ["mitGrant", "mitNotice", "mitAsIs", "mitLiability"]),
    ("MIT", ["mitGrant", "mitNotice"]),
    ("BSD-3-Clause", ["bsdIntro", "bsdSource", "bsdBinary", "bsdEndorse"]),
    ("BSD-2-Clause", ["bsdIntro", "bsdSource", "bsdBinary"]),
    ("Apache-2.0", ["apacheRef", "apacheComply", "apacheCopy", "apacheAsIs"]),
    ("Apache-2.0", ["apacheRef", "apacheComply", "apacheCopy"]),
    ("GPL-2.0-or-later", ["gplFree", "gplTerms", "gplTerms2p", "gplHope", "gplImplied", "gplSee"]),
    ("GPL-2.0-or-later", ["gplFree", "gplTerms", "gplTerms2p"]),
    ("GPL-3.0-or-later", ["gplTerms3pOne", "gplHope", "gplImplied", "gplSee"]),
    ("GPL-3.0-or-later", ["gplFree", "gplTerms", "gplTerms3p"]),
    ("MPL-2.0", ["mplRef", "mplCopy"]),
    ("MIT", ["mitRef"]), ("MIT", ["spdxMit"]),
    ("Apache-2.0", ["apacheRef"]), ("Apache-2.0", ["spdxApache"]),
    ("GPL-3.0-or-later", ["gplTerms3pOne"]), ("GPL-2.0-or-later", ["gplFree2p"]),
    ("GPL-3.0-only", ["gpl3Ref"]), ("GPL-2.0-only", ["gpl2Ref"]),
    ("GPL-2.0-only", ["spdxGpl2"]), ("GPL-2.0-or-later", ["spdxGpl2p"]),
    ("GPL-3.0-only", ["spdxGpl3"]), ("GPL-3.0-or-later", ["spdxGpl3p"]),
    ("LGPL-3.0-only", ["lgpl3Ref"]), ("AGPL-3.0-only", ["agpl3Ref"]),
    ("BSD-2-Clause", ["spdxBsd2"]), ("BSD-3-Clause", ["spdxBsd3"]),
    ("MPL-2.0", ["mplRef"]), ("MPL-2.0", ["spdxMpl"]),
    ("ISC", ["iscGrant"]), ("Unlicense", ["unlicense"]), ("public-domain", ["publicDomain"]),
    ("CC-BY-4.0", ["ccBy"]), ("CC-BY-SA-4.0", ["ccBySa"]), ("CC-BY-NC-4.0", ["ccByNc"]),
    ("CC-BY-NC-SA-4.0", ["ccByNcSa"]), ("CC-BY-ND-4.0", ["ccByNd"]),
    ("CC-BY-NC-ND-4.0", ["ccByNcNd"]), ("CC0-1.0", ["cc0"]),
    ("all-rights-reserved", ["allRights"]),
]

# Lower-cased texts hold no A-Z, so B can stand for a break that no sentence goes across.
BREAKS = r"[.!?;]+[ \t\f\n]+"
OTHER = r"[^a-z0-9B\n]+"
BLANK = r" ?\n ?\n[ \n]*|[ \n]*B[ \nB]*"


def _key(sentence: str) -> str:
    kept = "".join(c if c in ASCII_LOWER or c.isdigit() else " "
                   for c in sentence.lower())
    return " ".join(kept.split())


def dictionary() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    return {_key(text): ident for ident, text in SENTENCES}


def known_runs() -> dict[str, str]:
    """Normalised sentence, with B for the breaks it holds -> identifier; whole sentences first."""
    cut = {"B".join(map(_key, re.split(BREAKS, text))): ident for ident, text in SENTENCES}
    return dict(sorted(cut.items(), key=lambda kv: ("B" in kv[0], -len(kv[0]))))


def _run(idents: list[str]) -> str:
    return "".join(f"<{i}>" for i in idents)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Licences of every row: ``keep`` columns plus n_sentences, n_known, sentence_ids,
    licenses (comma-joined, sorted, distinct) and n_unmatched (known sentences in no rule)."""
    runs = known_runs()
    known = F.create_map(*[F.lit(x) for kv in runs.items() for x in kv])
    lower = F.translate(F.replace(text_or_empty(text), F.lit("\r\n"), F.lit("\n")),
                        ASCII_UPPER + "\r", ASCII_LOWER + "\n")
    norm = F.regexp_replace(F.regexp_replace(lower, BREAKS, "B"), OTHER, " ")
    norm = F.trim(F.regexp_replace(F.regexp_replace(norm, BLANK, "B"), " ?\\n ?", "\n"))
    either = "|".join(k.replace(" ", r"[ \n]") for k in runs)
    base = docs.select(*keep, norm.alias("_norm"))
    base = base.select(
        *keep, F.filter(F.split("_norm", r"[B\n]"), lambda s: ~s.isin("", " ")).alias("_sentences"),
        F.regexp_extract_all("_norm", F.lit(rf"(?<![^B\n])(?:{either})(?![^B\n])"), F.lit(0)).alias("_runs"))
    idents = F.transform("_runs", lambda r: F.try_element_at(known, F.translate(r, "\n", " ")))
    wrapped = F.length(F.regexp_replace(F.array_join("_runs", ""), r"[^\n]+", ""))
    base = base.select(*keep, (F.size("_sentences") - wrapped).cast("long").alias("n_sentences"),
                       idents.alias("_ids"))
    found = F.concat(*[F.array_join(F.transform("_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))),
                                    "")])
    for licence, idents_ in RULES:
        found = F.replace(found, F.lit(_run(idents_)), F.lit(f"[{licence}]"))
    return (base.withColumn("_found", found)
            .select(*keep, "n_sentences", F.size("_ids").cast("long").alias("n_known"),
                    F.array_join("_ids", ",").alias("sentence_ids"),
                    F.array_join(F.array_sort(F.array_distinct(
                        F.regexp_extract_all("_found", F.lit(r"\[([^\]]+)\]"), F.lit(1)))), ",")
                    .alias("licenses"),
                    F.size(F.regexp_extract_all("_found", F.lit("<([^>]+)>"), F.lit(1)))
                    .cast("long").alias("n_unmatched")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same result in DuckDB: sentences as rows joined to the dictionary."""
    rows = ", ".join("('{}', '{}')".format(k, v) for k, v in dictionary().items())
    found = "coalesce(string_agg('<' || ident || '>', '' ORDER BY pos), '')"
    for licence, idents in RULES:
        found = f"replace({found}, '{_run(idents)}', '[{licence}]')"
    return f"""
WITH known(sentence, ident) AS (VALUES {rows}),
cut AS (
  SELECT doc_id, row_number() OVER () AS rid,
         string_split(regexp_replace(regexp_replace(
             translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'),
             '[.!?;]+[ \\t\\f\\r\\n]+|[\\r\\n]+', chr(10), 'g'), '[^a-z0-9\\n]+', ' ', 'g'),
             chr(10)) AS parts
  FROM documents),
lines AS (
  SELECT rid, trim(unnest(parts)) AS sentence, generate_subscripts(parts, 1) AS pos FROM cut),
hits AS (
  SELECT rid, pos, ident FROM lines JOIN known USING (sentence)),
total AS (SELECT rid, count(*) FILTER (sentence <> '') AS n FROM lines GROUP BY rid),
seq AS (
  SELECT rid, count(*) AS n_known, string_agg(ident, ',' ORDER BY pos) AS ids, {found} AS found
  FROM hits GROUP BY rid)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences,
       CAST(coalesce(n_known, 0) AS BIGINT) AS n_known, coalesce(ids, '') AS sentence_ids,
       coalesce(array_to_string(list_sort(list_distinct(
           regexp_extract_all(found, '\\[([^\\]]+)\\]', 1))), ','), '') AS licenses,
       CAST(coalesce(len(regexp_extract_all(found, '<([^>]+)>', 1)), 0) AS BIGINT) AS n_unmatched
FROM cut LEFT JOIN total USING (rid) LEFT JOIN seq USING (rid)"""
