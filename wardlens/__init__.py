"""wardlens: parametrised Spark DataFrame operators for clinical-style analytics."""
