"""Jobs composed of operators: request planning, monthly load, the two reports."""
