"""Licence scans: passages of a text against licence templates by the Dice coefficient over word bigrams.

Texts and templates are lower-cased and reduced to words of letters and digits. A passage of W bigrams, d of them (different ones)
in a template of n, has Dice 2 d / (n + W). From a threshold t follow the size bounds: d >= t n / (2 - t), and
W <= n (2 - t) / t; texts and templates that can't meet them are never compared. Passages begin and end with a bigram of the
template, wherever they stand in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.llm import tokens, util

THRESHOLD = 0.8
_WORD = re.compile(r"[^\W_]+")

# The conditions that the BSD licences share, the one of the 3-clause licence, and the one on advertising before it.
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AD = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
# Short notices and the standard headers or operative paragraphs of common licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Apache-1.0", "Licensed under the Apache License, Version 1.0."),
    ("Apache-1.1", "Apache License, Version 1.1"),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache-1.1", "The Apache Software License, Version 1.1"),
    ("GPL-1.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 1, or (at your option) any later version."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.0", "Licensed under the GNU Library General Public License, version 2."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation"),
    ("GFDL-1.2", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.2 or any later version published by the Free Software Foundation"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3}"),
    ("BSD-3-Clause", f"{_BSD} 3. {_BSD_3}"),
    ("BSD-4-Clause", f"{_BSD} 3. {_BSD_AD} 4. {_BSD_3}"),
    ("BSD-4-Clause", f"{_BSD} {_BSD_AD} {_BSD_3}"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-1.0", "Licensed under the Eclipse Public License, version 1.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("BSL-1.0", "Licensed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"),
    ("Zlib", "Released under the zlib License."),
    ("Zlib", "Licensed under the zlib License."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("Artistic-1.0", "Licensed under the Artistic License, version 1.0."),
    ("Artistic-2.0", "Licensed under the Artistic License, version 2.0."),
    ("Artistic-1.0", "The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package"),
    ("Artistic-2.0", "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed. The intent is that the Copyright Holder maintains some artistic control over the development of that Package while still keeping the Package available as open source and free software."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("OFL-1.1", "Permission is hereby granted, free of charge, to any person obtaining a copy of the Font Software, to use, study, copy, merge, embed, modify, redistribute, and sell modified and unmodified copies of the Font Software, subject to the following conditions"),
    ("CDDL-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License."),
    ("CDDL-1.0", "Licensed under the Common Development and Distribution License, version 1.0."),
    ("CDDL-1.1", "Licensed under the Common Development and Distribution License, version 1.1."),
    ("EUPL-1.1", "Licensed under the EUPL, Version 1.1 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL (the \"Licence\"); You may not use this work except in compliance with the Licence."),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL (the \"Licence\"); You may not use this work except in compliance with the Licence."),
    ("EUPL-1.2", "Licensed under the European Union Public Licence, version 1.2."),
    ("EUPL-1.1", "Licensed under the European Union Public Licence, version 1.1."),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced or transmitted in any form without prior written permission."),
]


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bigrams(ws: list[str]) -> list[tuple[str, str]]:
    return list(zip(ws, ws[1:], strict=False))


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.names = [name for name, _ in templates]
        self.sets = [set(bigrams(words(text))) for _, text in templates]
        self.least = [threshold * len(s) / (2 - threshold) for s in self.sets]
        self.most = [len(s) * (2 - threshold) / threshold for s in self.sets]
        self.owners: dict[tuple[str, str], list[int]] = {}
        for k, s in enumerate(self.sets):
            for b in s:
                self.owners.setdefault(b, []).append(k)
        self.anchors = sorted({a for k in range(len(self.sets)) for a in self._anchors(k)})

    def _anchors(self, k: int) -> list[str]:
        """Words, longest first, without which too few bigrams of the template are left: each match has one of them."""
        left, out = set(self.sets[k]), []
        for w in sorted({w for b in left for w in b}, key=lambda w: (-len(w), w)):
            if len(left) < self.least[k]:
                break
            left = {b for b in left if w not in b}
            out.append(w)
        return out

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, Dice, start, end) of the passages found; they don't overlap, those that share most bigrams with a template come in first,
        so a licence whose text holds another's isn't taken for that one."""
        low = text.lower()
        if not any(a in low for a in self.anchors):
            return []
        if len(low) != len(text):  # a letter whose lower case is longer: offsets are then those of the words themselves
            spans = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text)]
        else:
            spans = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(low)]
        hits: dict[int, list[tuple[int, tuple[str, str]]]] = {}
        for i in range(len(spans) - 1):
            b = (spans[i][2], spans[i + 1][2])
            for k in self.owners.get(b, ()):
                hits.setdefault(k, []).append((i, b))
        found = []
        for k, at in hits.items():
            if len({b for _, b in at}) >= self.least[k]:
                found += self._passages(k, at)
        out: list[tuple[str, float, int, int]] = []
        for dice, n, first, last, k in sorted(found, key=lambda f: (-round(f[0] * (f[1] + f[3] - f[2] + 1)), -f[0], -f[1], f[2], f[4])):
            a, b = spans[first][0], spans[last + 1][1]
            if all(b <= x or a >= y for _, _, x, y in out):
                out.append((self.names[k], dice, a, b))
        return sorted(out, key=lambda f: f[2])

    def _passages(self, k: int, at: list[tuple[int, tuple[str, str]]]) -> list[tuple[float, int, int, int, int]]:
        """The best passage from each hit on, if it reaches the threshold."""
        n, out = len(self.sets[k]), []
        for s in range(len(at)):
            seen, best = set(), None
            for pos, b in at[s:]:
                w = pos - at[s][0] + 1
                if w > self.most[k]:
                    break
                seen.add(b)
                dice = 2 * len(seen) / (n + w)
                if dice >= self.threshold and (best is None or dice > best[0]):
                    best = (dice, n, at[s][0], pos, k)
            if best:
                out.append(best)
        return out


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, license (of the longest passage, or null), dice, n_found, found (all passages).

    Defined cases: null and empty texts have none. Ties go to the better passage, the longer template, then to the earlier passage, then to the
    earlier template. Repeated rows are scanned alike. Other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    kept: dict[str, Scanner] = {}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept.setdefault("scanner", Scanner(templates, threshold))
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                rows = [scanner.scan(t) if t else [] for t in part.column("text").to_pylist()]
                best = [max(r, key=lambda f: (f[3] - f[2], f[1], -f[2])) if r else (None, 0.0) for r in rows]
                kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best]), pa.array([len(r) for r in rows], pa.int32()), pa.array([[dict(license=x, dice=d, start=a, end=b) for x, d, a, b in r] for r in rows], kind)],
                    names=["doc_id", "license", "dice", "n_found", "found"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, license string, dice double, n_found int, found array<struct<license: string, dice: double, start: int, end: int>>")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(util.documents(spark, sf_dir))
