"""License scans by diagonal voting, with DataFrame expressions only.

A text is lower-cased (A-Z) and cut into words. All rolling word k-grams of all texts are joined by hash, and verified by their words,
to the places of the same k-grams in the templates. A hit at word ``i`` of a text and word ``j`` of a template votes for diagonal ``i - j``.
Neighbouring diagonals (words left out or put in) are merged from each one on over at most ``gap`` more, so a span never drifts by more than
``gap`` words in all. A merged diagonal with the needed share of the template's k-grams is verified by alignment: the longest chain of
its hits that goes forward in the text and in the template, each word of both used once. Its score is the number of template words in the chain over
the words of the template and those put in between; it is a span if its k-grams and its score reach the template's share. Of spans on diagonals at most ``gap`` apart the
best stays (score, votes, shorter, earlier). Exact templates need all their k-grams on one diagonal.

The templates are a parameter; their k-grams are broadcast only below ``BROADCAST_GRAMS``, else the join is shuffled. Words leave the
scan only as hits, so what is shuffled is one narrow row for each text and each hit; the k-grams of a hot text
stay where it is read.

Defined cases: a null text is empty and has no word; a text shorter than k words has no span; repeated rows are scanned one by
one; columns of the documents other than the id and the text are left out, so their names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GAP, K, BROADCAST_GRAMS = 3, 2, 200_000
#: Characters between words, as a Java pattern.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: 1: all k-grams on one diagonal; else the least share of them, and the least score.
    share: float = 1.0


#: Phrases of the base rule.
PHRASES = (Template("cc-by", "cc by"), Template("gpl", "general public license"), Template("reserved", "all rights reserved"))
#: Whole license texts that the method adds; like the notices they need a share of 0.7.
TEXTS = tuple(
    Template(label, " ".join(text.split()), 0.7)
    for label, text in (
        ("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software
            to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
            copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and
            this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind
            express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the
            authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
            connection with the software or the use or other dealings in the software"""),
        ("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above
            copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this
            software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or
            consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious
            action arising out of or in connection with the use or performance of this software"""),
        ("bsd", """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
            redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must
            reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the
            distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the
            implied warranties of merchantability and fitness for a particular purpose are disclaimed"""),
        ("zlib", """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from
            the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and
            redistribute it freely subject to the following restrictions"""),
        ("apache-2.0", """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a
            copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the
            license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language
            governing permissions and limitations under the license"""),
        ("gpl-3.0", """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the
            free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful
            but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more
            details you should have received a copy of the gnu general public license along with this program"""),
    )
)
#: Notices that the method adds; a span needs 70 of 100 k-grams.
NOTICES = tuple(
    Template(label, text, 0.7)
    for label, text in (
        ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
        ("apache-2.0", "licensed under the apache license version 2 0"),
        ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
        ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
        ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
        ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
        ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
        ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
        ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
        ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
        ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        ("mit", "released under the mit license"),
        ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    )
)


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, BETWEEN, -1), "")


def _grams(words: str, k: int) -> Column:
    return F.arrays_zip(*[(F.col(words) if i == 0 else F.slice(words, i + 1, F.greatest(F.size(words) - i, F.lit(0)))).alias(f"w{i}") for i in range(k)])


def _hash(k: int, prefix: str) -> Column:
    return F.xxhash64(*[F.col(f"{prefix}w{i}") for i in range(k)])


def template_grams(spark: SparkSession, templates: tuple[Template, ...], k: int) -> tuple[DataFrame, int]:
    """(template, label, needed share, number of k-grams, place, hash, words) rows, and how many there are."""
    rows = []
    for number, t in enumerate(templates):
        words = t.text.split()
        rows += [(number, t.label, float(t.share), len(words) - k + 1, j, *words[j : j + k]) for j in range(len(words) - k + 1)]
    kinds = "template int, label string, share double, n_grams int, at int, " + ", ".join(f"t_w{i} string" for i in range(k))
    return spark.createDataFrame(rows, kinds).withColumn("t_hash", _hash(k, "t_")), len(rows)


def _chains(hits: Column, k: int) -> Column:
    """For each hit (at, pos), in order: the longest chain that ends there, as (template words, k-grams, first, last). Of two hits that follow in the template,
    the later may follow at any distance in the text; else both must be apart by k words or more."""

    def step(chains: Column, h: Column) -> Column:
        def goes_on(c: Column) -> Column:
            near = (h["at"] - c["at"] < k) & (h["at"] > c["at"]) & (h["pos"] - c["last"] >= h["at"] - c["at"])
            return near | ((h["at"] - c["at"] >= k) & (h["pos"] - c["last"] >= k))

        longer = F.transform(F.filter(chains, goes_on), lambda c: F.struct((c["words"] + F.least(h["at"] - c["at"], F.lit(k))).alias("words"), (c["grams"] + 1).alias("grams"), c["first"].alias("first"), h["pos"].alias("last"), h["at"].alias("at")))
        alone = F.struct(F.lit(k).alias("words"), F.lit(1).alias("grams"), h["pos"].alias("first"), h["pos"].alias("last"), h["at"].alias("at"))
        return F.concat(chains, F.array(F.coalesce(F.array_max(longer), alone)))

    none = F.array().cast("array<struct<words:int,grams:int,first:int,last:int,at:int>>")
    return F.aggregate(hits, none, step)


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...], doc_id: str = "doc_id", text: str = "text", k: int = K, gap: int = GAP) -> DataFrame:
    """One row for each document: doc_id, n_words and ``spans`` (label, template, first word, end, score), sorted."""
    grams, n = template_grams(docs.sparkSession, templates, k)
    side = F.broadcast(grams) if n <= BROADCAST_GRAMS else grams
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    places = texts.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(_grams("words", k)).alias("pos", "g"))
    places = places.select("row", "doc_id", "n_words", "pos", *[F.col(f"g.w{i}").alias(f"w{i}") for i in range(k)]).withColumn("hash", _hash(k, ""))
    same = F.col("hash") == F.col("t_hash")
    for i in range(k):
        same = same & (F.col(f"w{i}") == F.col(f"t_w{i}"))
    # The first place of each text stays without a hit, so that every document has a row.
    hits = places.join(side, same, "left").where("template is not null or pos is null or pos = 0")
    own = ["row", "doc_id", "n_words", "template", "label", "share", "n_grams"]
    dealt = hits.select(*own, (F.col("pos") - F.col("at")).alias("diagonal"), "pos", "at").repartition("row")
    votes = dealt.groupBy(*own, "diagonal").agg(F.count("template").alias("n"), F.min("pos").alias("first"), F.collect_list(F.when(F.col("share") < 1, F.struct("at", "pos"))).alias("hits"))
    merged = Window.partitionBy("row", "template").orderBy("diagonal")
    ahead, behind = merged.rangeBetween(0, gap), merged.rangeBetween(-gap, 0)
    # A diagonal starts a span only if there are votes enough from it on; others stay where such a start reaches them.
    starts = votes.withColumn("starts", (F.col("share") < 1) & (F.sum("n").over(ahead) >= F.col("share") * F.col("n_grams")))
    near = starts.withColumn("reached", F.max("starts").over(behind))
    exact = (F.col("share") >= 1) & (F.col("n") == F.col("n_grams"))
    kept = near.withColumn("some", F.when(F.col("reached"), F.col("hits"))).withColumn("band", F.collect_list("some").over(ahead))
    chains = _chains(F.array_sort(F.flatten("band")), k)
    size = F.col("n_grams") + k - 1

    def scored(c: Column) -> Column:
        put_in = F.greatest(c["last"] + k - c["first"] - c["words"], F.lit(0))
        return F.struct((c["words"] / (size + put_in)).alias("score"), c["grams"].alias("grams"), (c["first"] - c["last"]).alias("short"), (-c["first"]).alias("early"))

    best = F.when(F.col("starts"), F.array_max(F.transform(chains, scored)))
    aligned = kept.withColumn("best", best)
    good = (F.col("best.grams") >= F.col("share") * F.col("n_grams")) & (F.col("best.score") >= F.col("share"))
    # Of good spans on neighbouring diagonals the best stays.
    found = aligned.withColumn("found", F.when(exact, F.struct(F.lit(1.0).alias("score"), F.col("n").cast("int").alias("grams"), (1 - F.col("n")).cast("int").alias("short"), (-F.col("first")).alias("early"))).when(good, F.col("best")))
    number = Window.partitionBy("row", "template", F.col("found").isNotNull()).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(number) > F.when(F.col("share") >= 1, 0).otherwise(gap)
    runs = found.withColumn("new", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)).withColumn("run", F.when(F.col("found").isNotNull(), F.sum("new").over(number)))
    one = runs.groupBy(*own, "run").agg(F.max("found").alias("found"))
    first = -F.col("found.early")
    span = F.when(F.col("found").isNotNull(), F.struct("label", "template", first.cast("long").alias("first"), (first - F.col("found.short") + k).cast("long").alias("end"), F.col("found.score").alias("score")))
    return one.groupBy("row", "doc_id", "n_words").agg(F.sort_array(F.collect_list(span)).alias("spans")).drop("row")
