"""Sources and sinks, and the views the queries read."""
