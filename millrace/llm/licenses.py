"""License recognition: known sentences become identifiers, sequences of identifiers become licenses.

A text is first written as its words, in lower case, with a mark where a sentence or paragraph ends and another
where only a line does. A known sentence is found wherever it stands between two marks of any kind, and may run over
line ends, so titles, wrapped headers and notices in comments are all read in one pass, by position.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public license texts and notices, by identifier, as they are usually written. The headers
# of GPL 2 and 3 begin with the same sentence but for the mark behind it.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                 "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
                 "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
                 "conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial "
                     "portions of the Software.",
    "mit-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                      "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache-2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-2-header-use": "you may not use this file except in compliance with the License.",
    "apache-2-header-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3-header-b": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                      "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2-header-a": "This program is free software;",
    "gpl-2-header-b": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                      "by the Free Software Foundation;",
    "gpl-2-header-c": "either version 2 of the License, or (at your option) any later version.",
    "lgpl-3-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "cc-by-4-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nd-4-notice": "Licensed under CC BY-ND 4.0.",
    "cc-by-4-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                  "this work.",
    "bsd-intro": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                 "the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission.",
    "bsd-2-notice": "Licensed under the BSD 2-Clause License.",
    "bsd-3-notice": "Licensed under the BSD 3-Clause License.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "unlicense-domain": "This is free and unencumbered software released into the public domain.",
    "all-rights": "All rights reserved under copyright.",
}
# What a run of recognised sentences, in this order, stands for.
RULES = [
    ("MIT", ["mit-notice"]), ("MIT", ["mit-notice-2"]), ("MIT", ["mit-grant", "mit-condition"]),
    ("Apache-2.0", ["apache-2-notice"]), ("Apache-2.0", ["apache-2-header", "apache-2-header-use"]),
    ("GPL-3.0", ["gpl-3-notice"]), ("GPL-3.0-or-later", ["gpl-2-header-a", "gpl-3-header-b"]), ("GPL-2.0", ["gpl-2-notice"]),
    ("GPL-2.0-or-later", ["gpl-2-header-a", "gpl-2-header-b", "gpl-2-header-c"]),
    ("LGPL-3.0", ["lgpl-3-notice"]), ("AGPL-3.0", ["agpl-3-notice"]),
    ("CC-BY-4.0", ["cc-by-4-notice"]), ("CC-BY-4.0", ["cc-by-4-long"]), ("CC-BY-SA-4.0", ["cc-by-sa-4-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-long"]), ("CC-BY-NC-4.0", ["cc-by-nc-4-notice"]), ("CC-BY-NC-4.0", ["cc-by-nc-4-long"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4-notice"]), ("CC-BY-ND-4.0", ["cc-by-nd-4-notice"]), ("CC0-1.0", ["cc0-notice"]),
    ("BSD-2-Clause", ["bsd-2-notice"]), ("BSD-2-Clause", ["bsd-intro", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-3-notice"]), ("BSD-3-Clause", ["bsd-intro", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("ISC", ["isc-grant"]), ("MPL-2.0", ["mpl-2-header"]), ("MPL-2.0", ["mpl-2-notice"]), ("Unlicense", ["unlicense-domain"]),
]
# Every sentence holds one of these; texts without any are not read further. They are single words, which
# normalising leaves in one piece whatever stands between words.
TRIGGER = r"licen[cs]e|copyright|permission|redistribut|software|unencumbered"
# Marks of the normalised text: the end of a sentence or paragraph, and the end of a line within it.
END, LINE = "|", "/"
_SPACE = r"[\x20\x09-\x0D]"
_STOP = rf"[.!?;:]{_SPACE}+"


def normalised(sentence: str) -> str:
    """Letters and digits in lower case, everything else as single spaces; END where a sentence ends inside."""
    plain = "".join(chr(ord(c) + 32) if c in string.ascii_uppercase else "-" if c in (END, LINE) else c for c in sentence)
    kept = re.sub(rf"[^a-z0-9{END}]+", " ", re.sub(_STOP, END, plain))
    return re.sub(rf" ?([{END}]) ?", r"\1", kept).strip()


def _marked(text: Column) -> Column:
    """The text as words with single spaces, END and LINE between them, END at both ends."""
    plain = F.translate(text, string.ascii_uppercase + END + LINE, string.ascii_lowercase + "--")
    marked = F.regexp_replace(F.regexp_replace(plain, _STOP, END), r"\r\n|[\n\r]", LINE)
    words = F.regexp_replace(marked, rf"[^a-z0-9{END}{LINE}]+", " ")
    words = F.concat(F.lit(END), F.trim(F.regexp_replace(words, rf" ?([{END}{LINE}]) ?", "$1")), F.lit(END))
    # A line end next to another mark has an empty line, or nothing, between them.
    return F.regexp_replace(words, rf"[{END}{LINE}]{{2,}}", END)


def _pattern() -> str:
    """Any known sentence between two marks, the longest first. Its words may stand on several lines."""
    def one(key: str) -> str:
        return rf"[ {LINE}{END}]".join(part.replace(" ", f"[ {LINE}]") for part in key.split(END))
    keys = sorted({normalised(s) for s in SENTENCES.values()}, key=lambda k: (-len(k), k))
    return rf"(?<=[{END}{LINE}])(?:{'|'.join(map(one, keys))})(?=[{END}{LINE}])"


def recognised(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order. Of sentences that begin at the same place the longest
    counts, and the next one begins where it ends or later."""
    plain = lambda s: F.translate(s, END + LINE, "  ")
    known = F.create_map(*(F.lit(x) for name, s in SENTENCES.items() for x in (normalised(s).replace(END, " "), name)))
    found = F.regexp_extract_all(_marked(text), F.lit(_pattern()), F.lit(0))
    return F.transform(found, lambda s: known[plain(s)])


def rules_in(identifiers: Column) -> Column:
    """Licenses whose rule is a run of the identifiers, sorted, each once. Of the rules that fit at one place only the
    longest counts there."""
    def at(place: Column) -> Column:
        found = F.lit(None).cast("string")
        for name, rule in sorted(RULES, key=lambda r: len(r[1])):  # a longer rule decides over those before it
            found = F.when(F.slice(identifiers, place, len(rule)) == F.array(*map(F.lit, rule)), F.lit(name)).otherwise(found)
        return found
    places = F.when(F.size(identifiers) > 0, F.sequence(F.lit(1), F.size(identifiers))).otherwise(F.array().cast("array<int>"))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(places, at))))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_sentences (known ones), sentences (their identifiers, in order), licenses.

    Everything happens within the row, so there is no shuffle. Null and empty texts have no sentences. Rows
    that repeat an id each give a row. Only the two named columns are read.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    ids = F.when(F.col("text").rlike(f"(?i){TRIGGER}"), recognised(F.col("text"))).otherwise(none)
    rows = docs.select("id", ids.alias("sentences"))
    return rows.select(F.col("id").alias(id_col), F.size("sentences").cast("bigint").alias("n_sentences"), "sentences",
                       rules_in(F.col("sentences")).alias("licenses"))
