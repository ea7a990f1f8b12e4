"""Provider compositions, testdata shapes and the registered queries."""
