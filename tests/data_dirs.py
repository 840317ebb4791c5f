"""Where the given tables are."""

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
