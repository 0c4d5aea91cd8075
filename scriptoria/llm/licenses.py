"""Licence scan by canonical digests: whole texts, and each line as a text of its own.

A text is made canonical (case, copyright lines, equivalent spellings, punctuation and white space) and
its digest joined to the digests of known licences, made the same way. Column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Short licences and the notices that stand for longer ones.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <http://unlicense.org/>"""
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT), ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("ISC", "Licensed under the ISC License."),
    ("Zlib", _ZLIB), ("Zlib", "zlib License\n\n" + _ZLIB),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."), ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."), ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC0-1.0", "Released under CC0 1.0."), ("CC0-1.0", "Licensed under CC0 1.0."), ("Unlicense", _UNLICENSE), ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]
# Digests of whole canonical texts that are too long to print here, made by flat(canonical()) and md5
# from the texts that their stewards publish (as Debian's base-files package carries them).
DIGESTS = [
    ("Apache-2.0", "3b54aa01c0392b1924b27d93edd17455"), ("Artistic-1.0-Perl", "a8b0fb0c6e43a3b36bdc159e59dbfd1e"), ("CC0-1.0", "93a180096f6cfcf2c0dd24f75c2eec48"),
    ("GFDL-1.2", "49ffacd2fea52c0c124f0d16bc990c74"), ("GFDL-1.3", "2d7ce083c264cf7f093acc742260e501"),
    ("GPL-1.0", "738cc3b112640d95d4cd79a58967ecea"), ("GPL-2.0", "5e39ace6e62f5a7fe9c17b4da986ad8c"), ("GPL-3.0", "b79359b5e391fd47146ff34ae3db7ec0"),
    ("LGPL-2.0", "74cf7fcef3b29a39165a795b2cad3a3a"), ("LGPL-2.1", "f998bc436710cfece156aaa84fd26dd4"), ("LGPL-3.0", "b31b7335bc37919e8cdd79154e04d88d"),
    ("MPL-1.1", "a708f02208e9c42d3644490185833425"), ("MPL-2.0", "0d0c617863ffeb16c5cb1f094c2d68b2"),
]
# Spellings that a licence matcher treats as one, as patterns over lower-cased text.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"), ("copyright owner", "copyright holder"), ("acknowledgement", "acknowledgment"),
    ("favour", "favor"), ("organisation", "organization"), ("recognise", "recognize"), ("judgement", "judgment"), ("merchantibility", "merchantability"), ("https://", "http://"),
]


def canonical(text: Column) -> Column:
    """Lower case; copyright lines emptied; one spelling; letters and digits joined by single spaces, line by line."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, r"(^|\n)[ \t#*/;-]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)|©)[^\n]*", "$1")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, r"[\x00-\x09\x0b-\x1f !-/:-@\[-`{-\x7f©–—‘’“”]+", " ")
    return F.regexp_replace(out, r" ?\n ?", "\n")


def flat(lines: Column) -> Column:
    """A canonical text on one line."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


#: Rows of a table of known licences at most; their digests stand in the plan.
LISTED = 20_000


def known(spark: SparkSession) -> DataFrame:
    """(digest, license) of the lists above: a fixed, small table."""
    rows = spark.createDataFrame(KNOWN, "license string, text string")
    made = rows.select(F.md5(flat(canonical(F.col("text")))).alias("digest"), "license")
    return made.unionByName(spark.createDataFrame(DIGESTS, "license string, digest string")).groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, license, line_licenses) for every row of docs(doc_id, text).

    digest is of the whole canonical text; license names the known licence that the entire text
    is, else null. line_licenses lists, sorted and joined by commas, the licences whose entire
    text is one line of the row's text; else null. Null and empty texts have the empty text's
    digest and no licence. Each row stands alone, so repeated and null ids need no rule.
    licenses(digest, license) replaces the built-in list; of one digest the least name counts, nulls are
    left out, and more than LISTED rows are refused. One scan of the texts, no shuffle.
    """
    table = known(docs.sparkSession) if licenses is None else licenses.select("digest", "license").where("digest is not null and license is not null").groupBy("digest").agg(F.min("license").alias("license"))
    listed = {r["digest"]: r["license"] for r in table.limit(LISTED + 1).collect()}
    if len(listed) > LISTED:
        raise ValueError(f"more than {LISTED} known digests")
    table = docs.sparkSession.createDataFrame(sorted(listed.items()), "digest string, license string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical(F.col("text").cast("string")).alias("lines"))
    lines = F.filter(F.transform(F.split("lines", "\n"), lambda line: F.trim(line)), lambda line: line != "")
    found = F.filter(F.transform(lines, F.md5), lambda d: d.isin(sorted(listed)))
    scanned = rows.select("doc_id", F.md5(flat(F.col("lines"))).alias("digest"), found.alias("found"))
    name = F.map_from_entries(F.array(*(F.struct(F.lit(d), F.lit(n)) for d, n in sorted(listed.items())))) if listed else F.lit(None).cast("map<string,string>")
    named = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda d: F.try_element_at(name, d)))), ",")
    return scanned.join(F.broadcast(table), "digest", "left").select("doc_id", "digest", "license", F.when(F.size("found") > 0, named).alias("line_licenses"))
