"""Sources and sinks: landed files, seeds, exports, and the test-table mapping."""
