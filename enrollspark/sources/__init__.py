"""Inputs and outputs: layout-driven delimited files, versioned state snapshots, test-table fixtures."""
