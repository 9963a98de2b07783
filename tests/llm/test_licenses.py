from pathlib import Path

from hourcast.llm import licenses

FILE = "doc_id long, path string, text string"
MIT = "Released under the MIT License."


def scan(spark, *rows):
    found = licenses.scan(spark.createDataFrame(rows, FILE)).collect()
    return {r["path"]: r["license"] for r in found}


def test_nearest_folder_above_gives_the_licence(spark):
    got = scan(
        spark,
        (1, "a/LICENSE", MIT + "\nmore text"),
        (2, "a/b/c/x", "nothing of that kind"),
        (3, "a/b/LICENSE", "All rights reserved."),
        (4, "a/y", None),
        (5, "z/y", ""),
        (6, "a/b/own", "code\nLicensed under the Apache License, Version 2.0"),
    )
    assert got == {
        "a/LICENSE": "MIT",
        "a/b/c/x": "Proprietary",
        "a/b/LICENSE": "Proprietary",
        "a/y": "MIT",
        "z/y": None,
        "a/b/own": "Apache-2.0",
    }


def test_header_inside_a_file_does_not_speak_for_its_folder(spark):
    got = scan(spark, (1, "a/x", "text\n" + MIT), (2, "a/y", "text"))
    assert got == {"a/x": "MIT", "a/y": None}


def test_most_licence_files_decide_and_ties_go_by_name(spark):
    got = scan(
        spark, (1, "a/1", MIT), (2, "a/2", "All rights reserved"), (3, "a/3", "x"), (4, "b/1", MIT),
        (5, "b/2", MIT), (6, "b/3", "All rights reserved"), (7, "b/4", "x"),
    )
    assert (got["a/3"], got["b/4"]) == ("MIT", "MIT")


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None, MIT), (None, "a/b", MIT), (2, "a/c", None), (2, "a/c", None), (3, "", "x")]
    found = licenses.scan(spark.createDataFrame(rows, FILE)).collect()
    assert len(found) == 5
    assert licenses.scan(spark.createDataFrame([], FILE)).count() == 0


APACHE = """/*
 * Copyright 2020 The Authors.
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
"""
GPL = """#!/usr/bin/python
# A tool, (C) 2019 Someone
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU {0}General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU {0}General Public License for more details.
#
# You should have received a copy of the GNU {0}General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


def test_wrapped_headers_count_as_one_text(spark):
    code = "\nint main() { return 0; }\n" * 50
    got = scan(
        spark, (1, "a/apache", APACHE + code), (2, "a/gpl", GPL.format("") + code),
        (3, "a/lgpl", GPL.format("Lesser ") + code), (4, "a/agpl", GPL.format("Affero ") + code), (5, "a/b", code),
    )
    assert got == {"a/apache": "Apache-2.0", "a/gpl": "GPL", "a/lgpl": "LGPL", "a/agpl": "AGPL", "a/b": None}


def test_full_licence_files_speak_for_their_folder(spark):
    text = {f.stem: f.read_text() for f in (Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    mit = "MIT License\n\nCopyright (c) 2021 A. Person\nAll rights reserved.\n\n" + licenses.LONG["MIT whole"]
    rows = [(1, "m/LICENSE", mit), (2, "m/deep/er/x", "x")]
    for i, name in enumerate(sorted(text)):
        rows += [(10 + i, f"{name}/COPYING.txt", text[name]), (50 + i, f"{name}/d/x", "x")]
    got = scan(spark, *rows)
    assert (got["m/LICENSE"], got["m/deep/er/x"]) == ("MIT", "MIT")
    for name in text:
        want = name.split("-")[0] if "GPL" in name else name
        assert (got[f"{name}/COPYING.txt"], got[f"{name}/d/x"]) == (want, want)


def test_titles_and_tags(spark):
    lines = {
        "MIT License": "MIT", "GNU GENERAL PUBLIC LICENSE": "GPL", "Apache License": "Apache-2.0",
        "// SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "Copyright (c) 2020 X. All rights reserved.": "Proprietary", "SPDX-License-Identifier: ISC": None,
        "The licence of the public house": None,
    }
    got = scan(spark, *((i, f"{i}/x", line) for i, line in enumerate(lines)))
    assert [got[f"{i}/x"] for i in range(len(lines))] == list(lines.values())


def test_ordinary_words_are_no_licence(spark):
    lines = ["The.", "the the", "Mit", "mit der", "Public.", "3", "under the", "All the", "License", "The license"]
    got = scan(spark, *((i, f"{i}/x", f"{line}\nfurther text") for i, line in enumerate(lines)))
    assert set(got.values()) == {None}


def test_every_template_names_a_licence():
    for templates in (licenses.TEMPLATES, licenses.SHORT, licenses.LONG):
        for name, text in templates.items():
            assert licenses.template_words(text) & set(licenses.NAMING), name
            assert licenses.least_telling(text) >= 1


def test_query_equals_sql_on_all_ranks(spark, tmp_path):
    """Blocks, lines and short forms, in several folders, against the oracle's SQL."""
    import duckdb
    from check import compare

    from hourcast.llm import oracles, queries

    texts = [
        APACHE + "code", GPL.format("") + "x\ny", GPL.format("Lesser "), "word\n" + MIT, MIT + "\nx", "The.\nx", None, "",
        "MIT License\n\ntext", "# SPDX-License-Identifier: MIT\nimport x", "<!-- GNU GENERAL PUBLIC LICENSE -->\nx",
        "\ufeff/* Mozilla Public License Version 2.0 */", "Copyright (c) 2020 X.\nAll rights reserved.", "no licence here",
        "Licensed under CC BY-NC 4.0", "#!/bin/sh\n# All rights reserved\n\ncode", "mit\nlicense", "; x\n; MIT License\ny",
    ]
    rows = [(k * 300, t, ("en", "de")[k % 2], f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    ours = queries.op10_license_scan(spark, str(tmp_path)).toPandas()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(ours, db.sql(oracles.oracle_sql()["op10_license_scan"]).df()) == ""
    assert ours["own_license"].notna().sum() >= 10
