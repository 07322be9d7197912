"""lamina: document-layout analytics as DataFrame-to-DataFrame steps on Spark."""
