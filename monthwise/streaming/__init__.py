"""Monthly refresh driven by newly landed submissions (see ``refresh``)."""
