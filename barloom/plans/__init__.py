"""Jobs: features, audits, validation, publishing."""
