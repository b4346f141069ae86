"""Licence recognition: sentences to identifiers, sequences of identifiers to licences. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of licence texts and notices, normalised, and their identifiers.
SENTENCES = {
    "apache-title": "apache license version 2 0 january 2004",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-the": "licensed under the apache license version 2 0 the license",
    "apache-notice-not-use": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-short": "released under the apache license 2 0",
    "apache-not-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-copy-url": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-no-event": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-released": "released under the bsd license",
    "bsd-3-released": "licensed under the bsd 3 clause license",
    "bsd-2-released": "licensed under the bsd 2 clause license",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl-3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-3-licensed": "licensed under the gnu general public license version 3",
    "gpl-2-licensed": "licensed under the gnu general public license version 2",
    "gpl-3-title": "gnu general public license version 3 29 june 2007",
    "gpl-2-title": "gnu general public license version 2 june 1991",
    "gpl-free": "this program is free software",
    "gpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-redistribute-3-or-later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-redistribute-2-or-later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-redistribute-3": "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "gpl-redistribute-2": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "lgpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl-redistribute-3-or-later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-redistribute-2-1-or-later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "agpl-redistribute-3-or-later": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gnu-3-or-later": "either version 3 of the license or at your option any later version",
    "gnu-2-1-or-later": "either version 2 1 of the license or at your option any later version",
    "gnu-2-or-later": "either version 2 of the license or at your option any later version",
    "gnu-2": "version 2 of the license",
    "lgpl-3-licensed": "licensed under the gnu lesser general public license version 3",
    "agpl-3-licensed": "licensed under the gnu affero general public license version 3",
    "mpl-2-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-nc-sa-4": "licensed under cc by nc sa 4 0",
    "cc0": "released under cc0 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "all-rights": "all rights reserved",
}

# Ordered rules, tried from the first to the last at each sentence; longer ones stand before their parts.
RULES = [
    ("Apache-2.0", ["apache-notice-the", "apache-not-use", "apache-copy", "apache-url", "apache-as-is"]),
    ("Apache-2.0", ["apache-notice-the", "apache-not-use", "apache-copy-url", "apache-as-is"]),
    ("Apache-2.0", ["apache-notice-the", "apache-not-use"]),
    ("Apache-2.0", ["apache-notice", "apache-not-use"]),
    ("Apache-2.0", ["apache-notice-not-use", "apache-copy", "apache-url", "apache-as-is"]),
    ("Apache-2.0", ["apache-notice-not-use"]),
    ("Apache-2.0", ["apache-notice-the"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-short"]),
    ("Apache-2.0", ["apache-title"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-no-event"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("ISC", ["isc-grant"]),
    ("BSD-3-Clause", ["all-rights", "bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["all-rights", "bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-3-released"]),
    ("BSD-2-Clause", ["bsd-2-released"]),
    ("BSD", ["bsd-released"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-redistribute-3-or-later"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-redistribute-2-or-later"]),
    ("LGPL-3.0-or-later", ["gpl-free", "lgpl-redistribute-3-or-later"]),
    ("LGPL-2.1-or-later", ["gpl-free", "lgpl-redistribute-2-1-or-later"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl-redistribute-3-or-later"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-redistribute", "gnu-3-or-later"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-redistribute", "gnu-2-or-later"]),
    ("GPL-2.0-only", ["gpl-free", "gpl-redistribute", "gnu-2"]),
    ("LGPL-2.1-or-later", ["gpl-free", "lgpl-redistribute", "gnu-2-1-or-later"]),
    ("LGPL-3.0-or-later", ["gpl-free", "lgpl-redistribute", "gnu-3-or-later"]),
    ("GPL-3.0-only", ["gpl-free", "gpl-redistribute-3"]),
    ("GPL-2.0-only", ["gpl-free", "gpl-redistribute-2"]),
    ("GPL-3.0-only", ["gpl-3-work"]),
    ("GPL-3.0-only", ["gpl-3-licensed"]),
    ("GPL-2.0-only", ["gpl-2-licensed"]),
    ("GPL-3.0", ["gpl-3-title"]),
    ("GPL-2.0", ["gpl-2-title"]),
    ("LGPL-3.0-only", ["lgpl-3-licensed"]),
    ("AGPL-3.0-only", ["agpl-3-licensed"]),
    ("MPL-2.0", ["mpl-2-subject"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("Proprietary", ["all-rights"]),
]

# What is done to a text before it is cut, in order: line ends, marks of comments and lists at the start
# of a line, the stop of an abbreviation that the sentence goes on after, and a blank line after one that names a copyright or a title.
PREPARED = [
    (r"\r\n?", "\n"),
    (r"(?m)^[ \t]*(?:/[/*]+|[*#;%>]+/?|--+|<!--+|(?:dnl|rem|REM)\b)[ \t]*", ""),
    (r"(?m)^[ \t]*(?:\(?[0-9a-z][.)]|[-o+])[ \t]+", ""),
    (r"\b([vV]|Inc|Ltd|Co|Corp)\.([ \t\n]+[a-z0-9])", r"\1\2"),
    (r"(?m)^([ \t]*(?:[Cc]opyright|COPYRIGHT|\([Cc]\)|[Tt]he [A-Z0-9-]+ [Ll]icen[cs]e|[A-Z0-9-]+ [Ll]icen[cs]e|Version [0-9.]+, [^\n]*[12][0-9]{3})\b[^\n]*)$", "\\1\n\n"),
]
#: Where a sentence ends: a stop or semicolon before white space, or a blank line.
BOUNDARY = r"[.!?;:]['\")\]]*[ \t\n\f]+|\n[ \t\f]*\n"
# Sentences that say the same, over normalised ones.
VARIANTS = [
    (r"\blicence\b", "license"),
    (r"^neither the names? of .+ nor the names of (?:its|their|any) contributors", "neither the name of the copyright holder nor the names of its contributors"),
    (r"^.+ is free software$", "this program is free software"),
    (r" including the next paragraph", ""),
    (r"^(redistributions? .+) must (retain|reproduce) the (above|accompanying) copyright notices? this", r"\1 must \2 the above copyright notice this"),
]
#: A sentence that is not known.
OTHER = "-"


def java(replacement: str) -> str:
    """A replacement whose groups are written as ``\\1``, as Spark wants it."""
    return replacement.replace("\\", "$")


def prepared(text: Column) -> Column:
    for pattern, replacement in PREPARED:
        # Only a line feed ends a line.
        text = F.regexp_replace(text, pattern.replace("(?m)", "(?md)"), java(replacement))
    return text


def plain(sentence: Column) -> Column:
    value = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
    for pattern, replacement in VARIANTS:
        value = F.regexp_replace(value, pattern, java(replacement))
    return value


def identifiers(text: Column, sentences: dict[str, str]) -> Column:
    """The identifier of each sentence of a text, OTHER for those that are not known.

    A sentence may be wrapped over several lines. One that is not known as a
    whole is looked at line by line. Pieces without two letters or digits in a
    row, such as numbers of a list, are no sentences.
    """
    table = F.create_map(*[F.lit(x) for name, sentence in sentences.items() for x in (sentence, name)])

    def known(sentence: Column) -> Column:
        return F.try_element_at(table, plain(sentence))

    def named(sentence: Column) -> Column:
        lines = F.transform(says_something(F.split(sentence, "\n")), lambda line: F.coalesce(known(line), F.lit(OTHER)))
        return F.when(known(sentence).isNotNull(), F.array(known(sentence))).when(F.contains(sentence, F.lit("\n")), lines).otherwise(F.array(F.lit(OTHER)))

    return F.flatten(F.transform(says_something(F.split(prepared(text), BOUNDARY)), named))


def says_something(pieces: Column) -> Column:
    return F.filter(pieces, lambda piece: F.rlike(piece, F.lit(r"[A-Za-z0-9]{2}")))


def scanned(
    docs: DataFrame,
    sentences: dict[str, str] = SENTENCES,
    rules: list[tuple[str, list[str]]] = RULES,
    text: str = "text",
    id: str = "doc_id",
) -> DataFrame:
    """One row per document: ``id``, n_sentences, n_known, licenses, matched.

    A text is cut into sentences at stops, semicolons and blank lines, after
    marks of comments and lists at the start of lines are taken away, so wrapped
    and commented texts read alike; each is lower-cased, anything but a-z and
    0-9 becomes one blank, variants become the usual words, and the result is
    looked up among the known sentences, or its lines are.
    The identifiers, in order, are matched against the rules: at each sentence
    the first rule whose identifiers follow one another from there (ties cannot
    be), then on after its last sentence. ``licenses`` lists the licences found,
    sorted and each once; ``matched`` the rules' identifiers in order of the text.

    Everything happens within a row, without a shuffle, and tables of sentences
    and rules are part of the plan. Every pattern runs in a time in proportion
    to the text, however long. NULL, empty and blank texts have no sentence and
    no licence. Rows that repeat get equal answers, NULL ids too. Other columns
    are not read.
    """
    # A rule is a pattern over the sequence in which each identifier stands between its own delimiters.
    held = {name: f"<{name}>" for name in sentences}
    pattern = "|".join("".join(held[i] for i in sequence) for _, sequence in rules)
    named = {"".join(held[i] for i in sequence): licence for licence, sequence in rules}
    licence = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    found = F.col("_found")
    return (
        docs.select(F.col(id), identifiers(F.col(text), sentences).alias("_ids"))
        .withColumn("_ids", F.coalesce("_ids", F.array().cast("array<string>")))
        .withColumn("_sequence", F.array_join(F.transform("_ids", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), ""))
        .withColumn("_found", F.regexp_extract_all("_sequence", F.lit(f"({pattern})")))
        .select(
            id,
            F.size("_ids").cast("long").alias("n_sentences"),
            F.size(F.filter("_ids", lambda x: x != OTHER)).cast("long").alias("n_known"),
            F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: licence[x]))), ",").alias("licenses"),
            F.array_join(found, " ").alias("matched"),
        )
    )
