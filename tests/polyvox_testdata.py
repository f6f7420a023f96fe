"""Where the tests find the small test tables (a module of its own: ``conftest`` names several files)."""

SF_SMALL = "/root/testdata/sf0.001"
