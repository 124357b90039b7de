"""Documents that several joins read are computed once."""

from __future__ import annotations

from checks import registered


def test_joined_checks_scan_a_written_table(spark):
    """No table of the folder is read again by the check itself."""
    for query in (registered.regex_violations_joined, registered.nonpermissible_joined):
        found = query(spark, "/root/testdata/sf0.001")
        assert found.inputFiles() and not any("/root/testdata" in f for f in found.inputFiles())
