"""ledgerloom: DataFrame jobs for published budget forms and text corpora."""
