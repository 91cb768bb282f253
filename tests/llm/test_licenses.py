import re
import textwrap

import numpy as np
import pytest

from tramlake.llm import licenses as L


def scan(spark, *texts):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, score string")
    return sorted((r.doc_id, r.paragraph, r.family) for r in L.query(docs).collect())


def test_every_notice_is_known(spark):
    notices = [(f, t) for f in L.NOTICES for t in L.NOTICES[f]]
    found = {r[0]: r[2] for r in scan(spark, *(t for _, t in notices))}
    assert sum(found.get(k) == f for k, (f, _) in enumerate(notices)) >= 0.9 * len(notices)
    assert all(k in found for k in range(len(notices)))
    assert scan(spark, *L.ORDINARY) == []


@pytest.mark.parametrize(("line", "family"), [
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"), ("RELEASED UNDER THE MIT LICENSE", "MIT"), ("  All rights reserved.  ", "Proprietary"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Released under the Foo Software License.", L.UNKNOWN),
])
def test_lines(spark, line, family):
    assert scan(spark, f"Prose of the day.\n\n{line}\nMore of it.") == [(0, 2, family)]


PROSE = "The people of the village gave their time to this study in the spring and again in the autumn of the same year, and two teams wrote it down by hand."


@pytest.mark.parametrize(("notice", "family"), [
    ("Licensed under CC BY 4.0.", "CC-BY"), ("Shared under CC BY-NC-SA 4.0 for all,", "CC-BY-NC"), ("all of it is licensed under the Apache License, Version 2.0, and", "Apache-2.0"),
    ("Copyright 2020 Example Corporation. All rights reserved.", "Proprietary"), ("which is released under the MIT License, as", "MIT"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA"),
])
def test_notices_inside_paragraphs(spark, notice, family):
    assert scan(spark, f"Day one.\n\n{PROSE} {notice} {PROSE}") == [(0, 2, family)]
    assert [f for _, _, f in scan(spark, textwrap.fill(f"{PROSE} {notice} {PROSE}", 40)) if f != L.UNKNOWN] == [family]
    assert scan(spark, f"{PROSE} {PROSE}") == []


@pytest.mark.parametrize(("kind", "version", "family"), [("", "3", "GPL-3.0"), ("", "2", "GPL-2.0"), ("Affero ", "3", "AGPL-3.0"), ("Lesser ", "2.1", "LGPL")])
def test_wrapped_headers(spark, kind, version, family):
    header = (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the "
        f"Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )
    widths = (50, 60, 70, 80)
    found = scan(spark, *("Code of the day.\n\n" + textwrap.fill(header, w) + "\n\nThis program is distributed in the hope that it will be useful." for w in widths))
    assert [(k, f) for k, _, f in found if f != L.UNKNOWN] == [(k, family) for k in range(len(widths))]


def test_long_notices_wrapped_or_not(spark):
    notices = {"MIT": L.PARAGRAPHS["MIT"][1], "GPL-3.0": L.PARAGRAPHS["GPL-3.0"][0], "Apache-2.0": L.PARAGRAPHS["Apache-2.0"][0], "ISC": L.PARAGRAPHS["ISC"][0]}
    cases = [(f, textwrap.indent(textwrap.fill(t, width) if width else t, mark)) for width in (0, 45, 75, 90) for mark in ("", " * ", "# ", "// ") for f, t in notices.items()]
    found = {(k, f) for k, _, f in scan(spark, *(t for _, t in cases)) if f != L.UNKNOWN}
    assert found == {(k, f) for k, (f, _) in enumerate(cases)}


# Wordings that training has not seen, with the family or None.
UNSEEN = (
    ("MIT", "You can use this package under the MIT license."), ("MIT", "The library is covered by the MIT License (see COPYING)."), ("MIT", "Everything here is offered under the MIT license, without warranty."),
    ("Apache-2.0", "Published under the Apache License, version 2.0."), ("Apache-2.0", "This library comes with the Apache License 2.0, which see."), ("Apache-2.0", "Contributions are accepted under the Apache License, Version 2.0."),
    ("GPL-3.0", "Available under the GNU General Public License version 3 (GPLv3)."), ("GPL-3.0", "You may use these scripts under the GNU GPL v3."), ("GPL-2.0", "It may be copied under the GNU General Public License version 2."),
    ("BSD", "Covered by the 3-clause BSD license."), ("BSD", "These headers are under the BSD license."), ("CC-BY", "Photos are shared under the Creative Commons Attribution 4.0 licence."),
    ("CC-BY-SA", "Content on this wiki is licensed under CC BY-SA 3.0."), ("CC-BY-NC", "Images: CC BY-NC 2.0"), ("CC-BY-NC", "These slides carry a Creative Commons Attribution-NonCommercial licence."),
    ("CC0-1.0", "Released to the public domain with CC0 1.0 Universal."), ("LGPL", "Linked under the GNU Lesser General Public License v2.1."), ("AGPL-3.0", "The server is offered under the GNU Affero General Public License v3."),
    ("MPL-2.0", "Files here fall under the Mozilla Public License 2.0."), ("ISC", "Offered under the ISC license."), ("Unlicense", "We put it out under the Unlicense."),
    ("Proprietary", "Copyright (c) 2019 Some Company Ltd. All rights reserved."), ("Proprietary", "Copyright 1998-2004 by the authors, all rights reserved worldwide."),
    ("Proprietary", "No portion of this publication may be reproduced without the written permission of the publisher."),
    (None, "The committee gave a license to the tavern on the corner."), (None, "She studied at MIT and later at Oxford."), (None, "The mozilla mascot is a red lizard."), (None, "Permission was not granted by the court."),
    (None, "The village reserved all seats for guests."), (None, "GNU tools are taught in the second year."), (None, "Version 3 of the map shows the new road."), (None, "Apache County is in Arizona."),
    (None, "He holds the rights to the film."), (None, "The domain of the function is the set of real numbers."), (None, "MIT"), (None, "License"), (None, "The license of the pilot was taken away in May."),
    (None, "Public licenses for taxis are drawn by lot."), (None, "Copying the picture took the painter three weeks."), (None, "Two versions of the general's story were published."),
)


def test_unseen_wordings(spark):
    found = {}
    for k, _, family in scan(spark, *(t for _, t in UNSEEN)):
        found.setdefault(k, []).append(family)
    known = {k: [f for f in v if f != L.UNKNOWN] for k, v in found.items()}
    right = [known.get(k, []) == ([f] if f else []) for k, (f, _) in enumerate(UNSEEN)]
    assert np.mean(right) >= 0.95, [t for (_, t), r in zip(UNSEEN, right, strict=True) if not r]
    assert not {t for _, t in UNSEEN} & {t for f in L.NOTICES for t in L.NOTICES[f]}


def test_every_notice_has_a_cue():
    assert all(re.search(L.CUES, t.lower()) for f in L.NOTICES for t in L.NOTICES[f])


def test_two_notices_in_a_paragraph(spark):
    assert scan(spark, f"{PROSE} Licensed under CC BY-NC 4.0. {PROSE} {PROSE} Released under the MIT License. {PROSE}") == [(0, 0, "CC-BY-NC"), (0, 0, "MIT")]


def test_nulls_empty_repeats(spark):
    assert scan(spark, None, "", "\n\n", "!!!", "the of and") == []
    docs = spark.createDataFrame([(1, "All rights reserved.")] * 3 + [(None, "All rights reserved.")], "doc_id long, text string")
    assert L.query(docs).count() == 4
    assert L.query(docs.limit(0)).count() == 0


def test_long_line(spark):
    assert scan(spark, "word " * 200_000) == []


def test_plan_is_native(spark, sf):
    plan = L.query(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
