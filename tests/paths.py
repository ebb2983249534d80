"""Folders of the given test tables, imported by the tests under this module's name."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
