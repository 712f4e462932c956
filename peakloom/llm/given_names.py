"""Given names that mark a name without a title, by gender; apart from the surrogates' names.

Left out are names that more often are another word or a place at the beginning of a sentence (such as Will, May, Art,
Grant, Les, Del, Paris, Jordan); those are found after a title only. ``n`` holds names of either gender.
"""

from __future__ import annotations

FEMALE = """
Abigail Ada Adele Adriana Agnes Agnieszka Aisha Alejandra Alexandra Alice Alicia Alina Alison Allison Amanda Amelia Amelie
Amina Amy Ana Anastasia Andrea Angela Angelica Angelika Angelina Anita Anja Anke Ann Anna Annabel Anne Anneliese Annette Annie
Annika Antje Antonia Ariana Ashley Astrid Audrey Aurelie Ava Barbara Beata Beate Beatrice Beatriz Becky Belinda Bernadette
Bettina Betty Beverly Bianca Birgit Blanca Bonnie Brenda Bridget Brigitte Britta Brittany Camila Camille Candace Carla Carmen
Carol Carole Caroline Carolyn Catalina Caterina Catherine Cathy Cecile Cecilia Celia Celine Chantal Charlotte Chiara
Chloe Christa Christiane Christina Christine Cindy Claire Clara Clarissa Claudia Colleen Concepcion Connie Consuelo Corinna
Corinne Cornelia Cristina Cynthia Dagmar Daniela Danielle Daphne Deborah Debra Delphine Denise Diana Diane Dolores Dominique
Donna Dora Doris Dorothea Dorothy Edith Eileen Elaine Eleanor Elena Eleonora Eliana Elisa Elisabeth Elise Eliza Elizabeth Elke
Ella Ellen Elodie Eloise Elsa Elvira Emily Emma Emilia Emilie Erica Erika Esmeralda Esperanza Estelle Esther Eugenia Eva
Evelyn Fatima Felicia Fernanda Fiona Frances Francesca Francoise Franziska Frida Friederike Gabriela Gabriele Gabriella
Gabrielle Genevieve Geraldine Gerda Gertrud Gertrude Ginevra Giovanna Gisela Giulia Gloria Greta Gudrun Guadalupe Gwendolyn
Hanna Hannah Hannelore Harriet Hazel Heather Heidi Heike Helen Helena Helene Helga Henriette Hilary Hilda Hildegard Ida
Ilona Ilse Imelda Imke Ingeborg Ingrid Inge Irene Irina Irma Isabel Isabella Isabelle Isobel Ivana Jacqueline Jana Jane Janet
Janice Janine Jasmine Jeanette Jeanne Jennifer Jenny Jessica Jill Joan Joanna Joanne Johanna Josefa Josefina Josephine Joyce
Juana Judith Judy Julia Juliana Julie Juliet Juliette Jutta Karen Karin Karina Karla Karolina Katarina Katarzyna Kate
Katharina Katherine Kathleen Kathrin Kathryn Kathy Katie Katja Katrin Kayla Keisha Kerstin Kimberly Kirsten Krystyna
Larissa Laura Lauren Laurence Lea Leila Lena Leonie Leonor Leticia Lidia Lieselotte Lina Linda Lisa Liselotte Livia Lois
Lorena Lorraine Louise Luana Lucia Luciana Lucie Lucille Lucy Ludmila Luisa Luise Luz Lydia Lynn Madeleine Madison
Magdalena Maggie Malgorzata Manon Manuela Marcela Marcia Margaret Margarete Margarita Margaux Margot Marguerite Maria
Mariana Marianne Maribel Marie Mariella Marietta Marilyn Marina Marion Marisol Marjorie Marlene Marta Martha Martina Mary
Mathilde Maureen Megan Melanie Melinda Melissa Mia Michaela Michele Michelle Mildred Miranda Miriam Moira Molly
Monica Monika Monique Muriel Nadia Nadine Nancy Naomi Natalia Natalie Natascha Natasha Nathalie Nicola Nicole Nina Noemi Nora
Norma Odile Olga Olivia Ottilie Paloma Pamela Patricia Patrizia Paula Paulina Pauline Peggy Penelope Petra Philippa Phyllis
Pilar Priscilla Priya Rachel Ramona Raquel Rebecca Regina Renata Renate Renee Rhonda Rita Roberta Rocio Rosa Rosalie Rosalind
Rosario Rosemarie Rosemary Roxana Ruth Sabine Sabrina Sally Samantha Sandra Sara Sarah Selina Sharon Sheila Shirley Sibylle
Silke Silvia Simona Simone Sofia Sofie Solange Sonia Sonja Sophia Sophie Stefania Stefanie Stella Stephanie Susan Susana
Susanna Susanne Suzanne Svenja Svetlana Sylvia Sylvie Tabea Tamara Tania Tanja Tatiana Tatjana Teresa Theresa Therese Tiffany
Tina Tracy Traute Ulrike Ursula Uschi Ute Valentina Valeria Valerie Vanessa Vera Verena Veronica Veronika Veronique Victoria
Viktoria Viola Violeta Virginie Vivian Viviane Waltraud Wanda Wendy Wilhelmina Wilma Ximena Yasmin Yolanda Yvette Yvonne
Zoe Zofia Zoya Agathe Aline Anaïs Aurélie Bénédicte Cécile Céline Chloé Élise Élodie Émilie Éloïse Estefanía Françoise
Geneviève Hélène Inès Inés Joëlle Léa Lucía Maëlle Margarethe Mónica María Noémie Renée Rocío Raphaëlle Sofía Thérèse Valérie
Véronique Verónica Zoé Ángela Begoña Belén Concepción Itziar Nuria Núria
Анна Александра Алёна Алина Алла Анастасия Антонина Валентина Валерия Вера Вероника Виктория Галина Дарья Ева Евгения
Екатерина Елена Елизавета Жанна Зинаида Зоя Инна Ирина Карина Кира Клавдия Кристина Ксения Лариса Лидия Лилия Любовь Людмила
Маргарита Марина Мария Надежда Наталия Наталья Нина Оксана Олеся Ольга Полина Раиса Светлана София Софья Тамара Татьяна Ульяна
Юлия Яна
Άννα Αγγελική Αθηνά Αικατερίνη Αλεξάνδρα Αναστασία Βασιλική Γεωργία Δέσποινα Δήμητρα Ειρήνη Ελένη Ελευθερία Ευαγγελία Ζωή
Θεοδώρα Ιωάννα Κατερίνα Κωνσταντίνα Μαρία Μαρίνα Νίκη Όλγα Παναγιώτα Παρασκευή Σοφία Σταυρούλα Στέλλα Φωτεινή Χριστίνα
"""

MALE = """
Aaron Abdul Abraham Adam Adolf Adrian Ahmed Alain Alan Albert Alberto Aldo Alejandro Alessandro Alexander Alexandre Alexei
Alfonso Alfred Alfredo Ali Allan Allen Alois Alvaro Amir Anatole Anders Andre Andreas Andrei Andres Andrew Andrzej Andy Angelo
Anthony Antoine Anton Antonio Armand Armando Arnaud Arne Arnold Arthur Arturo Augustin Aurelien Axel Baptiste Barry Bastian
Ben Benedikt Benito Benjamin Benoit Bernard Bernardo Bernd Bernhard Bert Bertrand Bjorn Björn Bob Bobby Boris Brad Bradley
Brandon Brendan Brian Bruce Bruno Bryan Calvin Camilo Carl Carlo Carlos Carsten Cedric Cesar Charles Charlie Chris Christof
Christoph Christophe Christopher Claude Claudio Clemens Clement Clifford Clive Colin Connor Conrad Constantin Cornelius Craig
Cristian Curtis Cyril Dale Damian Damien Dan Daniel Daniele Danny Darren Dave David Davide Dennis Denis Derek Detlef Dexter
Didier Diego Dieter Dietmar Dietrich Dirk Dmitri Dmitry Dominic Dominik Donald Douglas Duncan Dwayne Dylan Eberhard Eckhard
Edgar Edmund Eduard Eduardo Edward Edwin Egon Elias Elijah Elliot Emanuel Emil Emile Emiliano Emilio Emmanuel Enrico Enrique
Eric Erich Erik Ernest Ernesto Ernst Erwin Esteban Etienne Ethan Eugen Eugene Evan Fabian Fabien Fabio Fabrice Federico Felipe
Felix Ferdinand Fernando Filippo Florian Francesco Francis Francisco Franck Francois Frank Franz Fred Frederic Frederick
Friedrich Fritz Gabriel Gareth Garry Gary Gaston Gavin Geoffrey George Georg Georges Gerald Gerard Gerardo Gerd Gerhard Gert
Gilbert Gilles Giorgio Giovanni Giuseppe Gonzalo Gordon Graham Greg Gregor Gregory Guido Guillaume Guillermo Gunnar Gunter
Gustav Gustavo Günter Günther Hannes Hans Harald Harold Harry Hartmut Harvey Hassan Hector Heiko Heiner Heinrich
Heinz Helmut Henning Henri Henrik Henry Herbert Hermann Hernan Herve Holger Horst Howard Hubert Hugh Hugo Humberto Ian Ibrahim
Ignacio Igor Ingo Isaac Ismael Ivan Ivo Jack Jacob Jacques Jaime Jakob Jakub James Jamie Jan Jannik Jared Jason Javier Jean
Jeff Jeffrey Jens Jeremy Jerome Jerry Jesse Jim Jimmy Joachim Joaquin Jochen Joe Joel Joerg Johann Johannes John Johnny Jon
Jonas Jonathan Jorge Jose Josef Joseph Joshua Juan Julian Julien Julio Jurgen Justin Jörg Jürgen Kai Karl Karsten Kaspar Keith
Kenneth Kenny Kevin Klaus Konrad Konstantin Kristian Krzysztof Kurt Kyle Lars Larry Laurent Lawrence Leo Leon Leonard Leonardo
Leonhard Leopold Leroy Leslie Liam Lorenzo Lothar Louis Luc Luca Lucas Lucien Ludovic Ludwig Luigi Luis Lukas Luke Lutz
Magnus Malcolm Manfred Manuel Marc Marcel Marcello Marcelo Marco Marcos Marcus Marek Mario Marius Mark Marko Markus Martin
Marvin Massimo Mateo Mathias Mathieu Mats Matteo Matthew Matthias Matthieu Maurice Mauricio Mauro Max Maxime Maximilian Melvin
Michael Michal Michel Miguel Mike Mikhail Milan Milos Mirko Mitchell Mohamed Mohammad Mohammed Moritz Moses Muhammad Nathan
Nathaniel Neil Nicholas Nick Nicolas Niels Nigel Nikita Nikolai Nikolas Nikolaus Nils Noah Norbert Norman Oliver Olivier Omar
Oscar Oskar Osvaldo Otto Owen Pablo Paolo Pascal Patrice Patrick Paul Pedro Pete Peter Phil Philip Philipp Philippe
Phillip Pierre Pietro Piotr Quentin Rafael Rainer Rajesh Ralf Ralph Ramon Randy Raoul Raphael Raul Raymond Reginald
Reinhard Reinhold Remi Remy Rene Ricardo Riccardo Richard Rick Rob Robert Roberto Rodolfo Rodrigo Roger Roland Rolf Roman
Romain Ronald Ronny Rory Ross Roy Ruben Rudolf Rudi Rupert Russell Rüdiger Ryan Salvador Salvatore Samuel Sandro Sascha Scott
Sean Sebastian Sebastien Serge Sergei Sergio Seth Shane Shaun Shawn Siegfried Simon Spencer Stanislaw Stanley Stefan Stefano
Steffen Stephan Stephane Stephen Steve Steven Stewart Stuart Sven Sylvain Tadeusz Ted Terence Terry Theo Theodor Theodore
Thibault Thierry Thilo Thomas Thorsten Tim Timothy Tobias Todd Tom Tomas Tomasz Tommy Tony Torsten Travis Trevor Tristan
Udo Ulf Ulrich Umberto Uwe Valentin Vernon Vicente Victor Viktor Vincent Vincenzo Vittorio Vladimir Volker Waldemar Walter
Warren Wayne Werner Wesley Wilhelm William Wojciech Wolfgang Wolfram Xavier Yannick Yusuf Yves Zachary
Alejo Álvaro Ángel Andrés André Benoît Cédric César Clément Didrik Étienne Fabián François Frédéric Gérard Germán Héctor Hernán
Hervé Iñaki Iván Jérôme Jérémy Jesús Joaquín José Julián Léon Mathéo Martín Moisés Nicolás Óscar Raúl René Ramón Rubén Rémi Rémy
Sébastien Stéphane Théo Tomás Víctor
Александр Алексей Анатолий Андрей Антон Аркадий Артём Артур Богдан Борис Вадим Валентин Валерий Василий Виктор Виталий Владимир
Владислав Вячеслав Геннадий Георгий Григорий Даниил Денис Дмитрий Евгений Егор Иван Игорь Илья Кирилл Константин Лев Леонид
Максим Матвей Михаил Никита Николай Олег Павел Пётр Роман Руслан Семён Сергей Станислав Степан Тимур Фёдор Эдуард Юрий Яков
Ярослав
Αλέξανδρος Αλέξης Ανδρέας Αντώνης Απόστολος Αριστείδης Βασίλης Γεώργιος Γιάννης Γιώργος Γρηγόρης Δημήτρης Δημήτριος Ευάγγελος
Ηλίας Θανάσης Θεόδωρος Ιωάννης Κυριάκος Κώστας Κωνσταντίνος Λευτέρης Μανώλης Μιχάλης Νικόλαος Νίκος Παναγιώτης Παύλος Πέτρος
Σπύρος Σταύρος Στέφανος Σωτήρης Φίλιππος Χρήστος
"""

NEUTRAL = "Alex Alexis Billie Casey Jackie Jessie Jo Kelly Kim Kris Lou Morgan Nicky Noor Robin Sacha Sam Sandy Shannon Stacy Taylor Toni"

NAMES = {"f": set(FEMALE.split()), "m": set(MALE.split()), "n": set(NEUTRAL.split())}
