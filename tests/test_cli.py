"""The command line runs the sync pass and the copy job."""

from __future__ import annotations

import json

from reelsync.__main__ import main

from .conftest import SF_SMALL


def test_sync_twice_then_copy(spark, tmp_path, capsys):
    root = str(tmp_path)
    assert main(["sync", "--sf-dir", SF_SMALL, "--root", root, "--master", "local[*]"]) == 0
    assert main(["sync", "--sf-dir", SF_SMALL, "--root", root, "--master", "local[*]"]) == 0
    first, second = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert (first["pass_id"], second["pass_id"]) == (1, 2)
    assert second["version"] == first["version"]          # nothing changed: no new version
    assert main(["copy", "--sf-dir", SF_SMALL, "--root", root, "--master", "local[*]"]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert len(rows) == 5 and all(r["match"] for r in rows)
