"""Binary-outcome modelling on Spark: hash splits and samples (split), exact
preprocessing statistics (prep), Spark ML stages (stages), candidates and
search grids (train), fit / benchmark / tune / score (workflow), metrics and
curves (evaluate) and attributions (explain)."""
