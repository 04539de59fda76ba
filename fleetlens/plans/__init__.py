"""Report plans: pure functions from a ReportRun to a DataFrame."""
