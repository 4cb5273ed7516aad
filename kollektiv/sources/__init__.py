"""Sources: landing-folder archives, XML record extraction, bronze scans."""
