import pytest

import usagelens as ul
from tests.conftest import rows


@pytest.fixture
def scan(sources):
    """Facts and files of ``{path: content}``."""

    def build(files):
        table = sources(files)
        return ul.extract_facts(table).persist(), table.select("repo", "path")

    return build


def called(scan, files, mode="reference", external_only=False):
    facts, paths = scan(files)
    found = ul.collect_api_calls(facts, paths, external_only, mode)
    return rows(found, "file", "symbol_called", "library", "is_external", "defining_file", "import_module")


def test_symbol_targets(scan):
    code = "from colorsys import hls_to_rgb as paint\nimport fractions as fr, wave\n"
    facts, _ = scan({"a.py": code})
    assert rows(ul.symbols(facts), "name", "target") == [
        ("fr", "fractions"),
        ("paint", "colorsys.hls_to_rgb"),
        ("wave", "wave"),
    ]


def test_first_import_wins_over_later_bindings(scan):
    code = "def x(): pass\nimport a as x\nimport b as x\nx = 1\nx.f()\n"
    facts, _ = scan({"m.py": code})
    (found,) = ul.symbols(facts).collect()
    assert (found.name, found.target) == ("x", "a")
    assert found.declarations == [
        "<import>",
        "import a as x  (m.py @ offset 2)",
        "<import>",
        "import b as x  (m.py @ offset 3)",
        "<function>",
        "def x(...)  (m.py:1:0)",
        "<variable>",
        "x = <value>  (m.py:4:0)",
    ]
    assert called(scan, {"m.py": code}) == [("m.py", "a.f", "a", True, None, "a")]


def test_star_import_binds_a_star(scan):
    facts, _ = scan({"a.py": "from m import *\ng()\n"})
    assert rows(ul.symbols(facts), "name", "target") == [("*", "m.*")]
    assert called(scan, {"a.py": "from m import *\ng()\n"}) == []


def test_relative_import_of_a_package_binds_nothing(scan):
    files = {"p/a.py": "from . import x\nx.f()\n", "p/x.py": "def f(): pass\n", "p/__init__.py": ""}
    facts, paths = scan(files)
    assert rows(ul.symbols(facts), "path", "name") == [("p/x.py", "f")]
    edges = rows(ul.import_edges(facts, paths), "path", "module", "file", "is_local", "imported_names")
    assert edges == [("p/a.py", "p", "p/__init__.py", True, ["x"])]
    assert called(scan, files, "full") == [("p/a.py", "p.x.f", "p", False, "p/x.py", "p.x")]


def test_import_from_the_root_folder(scan):
    files = {"m.py": "from . import u\nu.f()\n", "u.py": "", "p/n.py": "from .. import u as v, w\nv.g()\nw.h()\n"}
    assert called(scan, files, "full") == [
        ("m.py", "u.f", "u", False, "u.py", "u"),
        ("p/n.py", "u.g", "u", False, "u.py", "u"),
        ("p/n.py", "w.h", "w", True, None, "w"),
    ]


def test_dotted_import(scan):
    code = {"a.py": 'import os.path\nos.path.join("a")\n'}
    assert called(scan, code) == [("a.py", "os.path.path.join", "os", True, None, "os.path")]
    assert called(scan, code, "full") == [("a.py", "os.path.join", "os", True, None, "os")]


def test_dotted_local_import(scan):
    files = {"m.py": "import pkg.u as v\nv.f()\n", "pkg/u.py": "def f(): pass\n"}
    assert called(scan, files) == [("m.py", "pkg.u.f", "pkg", True, None, "pkg.u")]
    assert called(scan, files, "full") == [("m.py", "pkg.u.f", "pkg", False, "pkg/u.py", "pkg.u")]


def test_dotted_import_finds_the_edge_of_another_statement(scan):
    files = {"m.py": "import pkg.u as v\nimport pkg\nv.f()\n", "pkg/__init__.py": ""}
    assert called(scan, files) == [("m.py", "pkg.u.f", "pkg", False, "pkg/__init__.py", "pkg.u")]


def test_relative_import_inside_a_package(scan):
    files = {"pkg/a.py": "from .u import f\nf()\n", "pkg/u.py": "def f(): pass\n"}
    facts, paths = scan(files)
    edges = rows(ul.import_edges(facts, paths), "path", "module", "file", "is_local")
    assert edges == [("pkg/a.py", "pkg.u", "pkg/u.py", True)]
    assert called(scan, files) == [("pkg/a.py", "u.f", "u", True, None, "u.f")]
    assert called(scan, files, "full") == [
        ("pkg/a.py", "pkg.u.f", "pkg", False, "pkg/u.py", "pkg.u.f")
    ]


def test_import_that_climbs_out_of_the_repo(scan):
    files = {"a.py": "from ...x import f\nf()\n"}
    assert called(scan, files) == [("a.py", "x.f", "x", True, None, "x.f")]
    assert called(scan, files, "full") == [("a.py", "x.f", "x", True, None, "x.f")]


def test_submodule_of_a_package(scan):
    files = {
        "m.py": "from pkg import mod\nmod.f()\n",
        "pkg/__init__.py": "",
        "pkg/mod.py": "def f(): pass\n",
    }
    assert called(scan, files) == [("m.py", "pkg.mod.f", "pkg", False, "pkg/__init__.py", "pkg.mod")]
    assert called(scan, files, "full") == [("m.py", "pkg.mod.f", "pkg", False, "pkg/mod.py", "pkg.mod")]


def test_function_level_import_is_visible_file_wide(scan):
    files = {"a.py": "def g():\n    import json\njson.dumps(1)\n"}
    assert called(scan, files) == [("a.py", "json.dumps", "json", True, None, "json")]


def test_local_calls_only_on_request(scan):
    files = {"m.py": "from util import norm\ndef own(): pass\nnorm()\nown()\nprint(1)\n"}
    files["util.py"] = "def norm(): pass\n"
    assert called(scan, files) == [
        ("m.py", "own", "own", False, "m.py", None),
        ("m.py", "util.norm", "util", False, "util.py", "util.norm"),
    ]
    assert called(scan, files, external_only=True) == []


def test_module_file_wins_over_package(scan):
    files = {"a.py": "import m\n", "m.py": "", "m/__init__.py": "", "n/__init__.py": "", "__init__.py": ""}
    facts, paths = scan(files)
    assert rows(ul.import_edges(facts, paths), "module", "file") == [("m", "m.py")]
    assert rows(ul.module_index(paths), "module", "file") == [
        ("__init__", "__init__.py"),
        ("a", "a.py"),
        ("m", "m.py"),
        ("m.__init__", "m/__init__.py"),
        ("n", "n/__init__.py"),
        ("n.__init__", "n/__init__.py"),
    ]


def test_dotted_folders_are_not_importable(spark):
    files = spark.createDataFrame([("r", "a.b/c.py"), ("r", "x.y.py"), ("r", ".venv/z.py")], ["repo", "path"])
    assert ul.module_index(files).count() == 0


def test_resolve_names_is_null_where_no_edge_matches(spark, scan):
    facts, paths = scan({"a.py": "import os.path\nimport re\nY = 1\n"})
    names = spark.createDataFrame([("r", "a.py", n) for n in ("os", "re", "Y", "nope")], ["repo", "path", "name"])
    found = ul.resolve_names(names, facts, paths)
    assert rows(found, "name", "import_module", "is_import", "import_is_local", "defining_file") == [
        ("Y", None, False, None, "a.py"),
        ("os", "os.path", True, None, None),
        ("re", "re", True, False, None),
    ]
    assert rows(ul.lookup_names(names, facts), "name", "target") == [
        ("Y", None),
        ("os", "os.path"),
        ("re", "re"),
    ]


def test_unknown_mode_is_refused(scan):
    with pytest.raises(ValueError, match="mode"):
        called(scan, {"a.py": "f()\n"}, mode="other")


def test_qualified_names(spark, scan):
    files = {
        "a.py": "import util\nimport bad\nimport re\nutil.norm()\ndef own(): pass\n",
        "util.py": "from re import sub\ndef norm(): pass\n",
        "bad.py": "import broken(",
    }
    facts, paths = scan(files)
    asked = [("util", "norm"), ("util", "sub"), ("util", "none"), ("bad", "x"), ("re", "sub"), ("own", "x")]
    names = spark.createDataFrame([("r", "a.py", b, a) for b, a in asked], ["repo", "path", "base_name", "attr_name"])
    found = ul.resolve_qualified(names, facts, paths)
    assert rows(found, "base_name", "attr_name", "attr_found", "attr_target", "attr_defining_file") == [
        ("bad", "x", False, None, None),
        ("own", "x", False, None, None),
        ("re", "sub", False, None, None),
        ("util", "none", False, None, None),
        ("util", "norm", True, None, "util.py"),
        ("util", "sub", True, "re.sub", "util.py"),
    ]


def test_dependents_list_each_importer_once(scan):
    files = {"a.py": "import u\nfrom u import f\n", "b.py": "import u, v\n", "u.py": "", "v.py": ""}
    facts, paths = scan(files)
    edges = ul.import_edges(facts, paths).persist()
    assert rows(ul.dependents(edges, "r", "u.py"), "dependent") == [("a.py",), ("b.py",)]
    assert ul.dependents(edges).count() == 3
    assert rows(ul.imports_of(edges, "r", "b.py"), "module") == [("u",), ("v",)]


def test_repos_do_not_mix(spark):
    code = [("one", "a.py", "import u\nu.f()\n"), ("two", "a.py", "import u\nu.f()\n"), ("two", "u.py", "")]
    table = spark.createDataFrame(code, ["repo", "path", "content"])
    facts = ul.extract_facts(table).persist()
    found = ul.collect_api_calls(facts, table, external_only=False)
    assert rows(found, "repo", "is_external") == [("one", True), ("two", False)]


def test_event_of_a_call(scan):
    import datetime

    facts, paths = scan({"p/a.py": 'import pandas as pd\npd.read_csv("f", **k)\n'})
    now = datetime.datetime(2024, 1, 2, 3, 4, 5, 678901, datetime.timezone.utc)
    events = ul.call_events(ul.collect_api_calls(facts, paths), now)
    (message,) = ul.to_messages(events).collect()
    assert bytes(message.value).decode() == (
        '{"repo":"r","file":"r/p/a.py","symbol_called":"pandas.read_csv","library":"pandas",'
        '"signature_shape":{"positional_count":1,"keyword_args":[],"has_varargs":false,'
        '"has_varkw":true},"is_external":true,"defining_file":null,"import_module":"pandas",'
        '"commit_hash":null,"timestamp":"2024-01-02T03:04:05.678901+00:00"}'
    )
