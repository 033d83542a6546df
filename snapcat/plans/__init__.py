"""Layer plans: Bronze, Silver, Gold, marts, analyses, reads."""
