"""End-to-end plans: file source, file sink, sheet source, sheet sink."""
