"""Layer builds: silver (typed, cleaned, FK-valid), gold (star schema), KPIs, full run."""
